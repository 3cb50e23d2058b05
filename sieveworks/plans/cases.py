"""Hand-made pages and interface pages for the queries on markup: each tells one rule."""

DETAILS = (
    # the newer layout: an info box with place, reference and date
    '<html><head><title>x</title></head><body><nav>Home</nav><h2 class="banner__text__title">Harbour Clerk</h2><div class="box jobInfo">\n Oslo, Norway\n Ref# 12\n Date published: 3-Mar-2017\n</div>'
    '<article class="article article--details"><p>We look for a full-time clerk who keeps the harbour log and answers calls from ferry crews every day of the week.</p><ul><li>Forms by post</li></ul></article><footer>Imprint</footer></body></html>',
    # an info box that begins with the reference; place and date from the text
    '<body><h1 class="page-title">Night Buyer</h1><div class="jobInfo">Ref# 7, Oslo</div><p>Work Location: Bergen, USA</p>\n<p>Posted Date: 01/27/2026</p></body>',
    # selectors for place, team and date; no body long enough
    '<body><h1>Planner</h1><div class="article__content__view__field__value">Lyon, France</div><span class="team">Fleet</span><time>2024-02-01</time></body>',
    # JSON-LD wins; without a stated kind of employment none is inferred
    '<head><script type="application/ld+json">{"@type":"JobPosting","title":"Welder","datePosted":"2024-05-06","jobLocation":{"address":{"addressLocality":"Kiel","addressCountry":"DE"}},"hiringOrganization":{"name":"Acme"}}</script></head><body><h1>Other</h1><div class="jobInfo">Bonn, DE</div><p>full-time</p></body>',
    # title by meta, then by the title element
    '<head><meta property="og:title" content="Tram Driver"><title>y</title></head><body><p>remote</p></body>', "<title>Cook | Acme</title><p>none</p>",
    # a box without anything like a place
    '<body><h1>Porter</h1><div class="jobInfo">Main building</div></body>', "",
)
LISTINGS = (
    '<div class="job-card"><a href="/job/1"><h3>Harbour Clerk</h3></a><span class="job-location">Oslo</span><span class="department">Ops</span></div><div class="job-card"><p>no link</p></div><div class="JOB-CARD x"><a href="b/2?x=1">Buyer - Apply Now</a></div>',
    '<a href="/careers/JobDetail/Clerk/12345">Night clerk</a><a href="/about">About us all</a><a href="/job/9">abc</a><a href="https://o.example/position/8">Day <b>buyer</b></a>',
    '<article class="jobs"><h2>Cook</h2><a href="../3">more</a></article>', '<div class="search-result"><a href="4">Porter</a></div><div class="research-result"><a href="5">No</a></div>', "<p>nothing</p>", "",
)
MARKUP = (
    "<div><nav>Menu</nav><p>One</p><!-- c --><script>x()</script><p>Two<br>lines</p><footer>Foot</footer></div>", '<p style="display: none">A</p><p style="opacity:0.9">B</p><p style="color:red">C</p>',
    '<div class="Cookie-Bar">A</div><div class="main">B<span class="share-links">S</span></div>', "<ul><li>one<li>two &amp; three</ul>", "<div><p><span> </span></p></div><p>x</p>", "<p>a</p></b></div>tail", '<p>a   b\n c</p><hr><img src="x">', "",
)
FACETS = (
    '<select name="filter_city"><option value="">All</option><option value="1">Oslo</option><option value="2">Kiel</option></select><select name="sort"><option value="a">A</option></select>',
    '<div class="facet" data-facet="team"><input value="ops"><input value="fleet"></div><select id="kind"><option value="f">Full</option></select><select><option value="z">Z</option></select>',
    '<select name="page"><option value="1">1</option></select>', "<p>none</p>",
)
#: (site, page, records on it, stated total)
API_PAGES = (("a", 1, 10, 25), ("a", 2, 10, 25), ("a", 3, 5, 25), ("a", 4, 5, 25), ("b", 1, 10, None), ("b", 2, 10, None), ("c", 1, 10, 90), ("c", 2, 0, 90), ("c", 3, 4, 90), ("c", 4, 0, 90), ("c", 5, 0, 90), ("c", 6, 8, 90), ("d", 1, 0, 0), ("d", 2, 0, 0))
