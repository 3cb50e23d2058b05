"""Free-entered values mapped to the entries of a reference list by a prefix-filter set-similarity join.

Both sides are sets of tokens (padded character pairs of the folded text, numbered where a pair repeats). Tokens are ordered
by their global rarity; a pair of sets with Jaccard >= t shares one of the rarest len - ceil(t * len) + 1 tokens of each, so
only these prefixes are joined. Length and positional filters cut the candidates, Jaccard is verified exactly, and the best
entry per value is kept. Exact copies are joined once, as distinct values.

Defined results
---------------
* missing values (NULL, empty, white space) and values that equal a label exactly have no row;
* a value that names no entry gets 0; ties go to the entry with the higher Jaccard, then the smaller edit distance, then the
  smaller id; an ambiguous place name without any hint of its region names its first entry;
* repeated rows each get a row; an empty reference list maps everything to 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import broadcast_if_small, materialise, missing

JACCARD = 0.4


def fold(c: Column) -> Column:
    """Lower case, accents of Latin letters off, white space to single spaces."""
    plain = F.regexp_replace(F.lower(c), r"[’`´]", "'")
    pairs = ("àáâãäåāăą", "a"), ("èéêëēėęě", "e"), ("ìíîïīį", "i"), ("òóôõöøōő", "o"), ("ùúûüūůű", "u"), ("çćč", "c"), ("ñń", "n"), ("ýÿ", "y"), ("šś", "s"), ("žźż", "z"), ("ğ", "g"), ("ł", "l")
    src, dst = "".join(a for a, _ in pairs), "".join(b * len(a) for a, b in pairs)
    return F.trim(F.regexp_replace(F.translate(plain, src, dst), r"(?U)[\s ]+", " "))


def pairs_of(c: Column) -> Column:
    """Padded character pairs of a text as a set; a pair's n-th occurrence is a token of its own."""
    padded = F.concat(F.lit("^"), c, F.lit("$"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2)))
    times = lambda g: F.size(F.filter(grams, lambda h: h == g))
    numbered = F.flatten(F.transform(F.array_distinct(grams), lambda g: F.transform(F.sequence(F.lit(1), times(g)), lambda n: F.concat(g, n.cast("string")))))
    return F.when(F.length(c) > 0, numbered).otherwise(F.array().cast("array<string>"))


def spread(df: DataFrame, rows: int = 1_000) -> DataFrame:
    """``df`` (materialised) in partitions of about ``rows`` rows: few bytes, but costly to look at, so bytes don't tell the number."""
    return df.repartition(max(1, -(-df.count() // rows)))


def jaccard_join(left: DataFrame, right: DataFrame, left_text: str, right_text: str, t: float = JACCARD) -> DataFrame:
    """Pairs (left_text, right_text, jaccard) of distinct texts with Jaccard >= t.

    Left and right hold a text per row; the texts are made distinct first. The right side's prefixes are broadcast only if few.
    """
    a = left.select(F.col(left_text).alias("a")).filter(F.length("a") > 0).distinct()
    b = right.select(F.col(right_text).alias("b")).filter(F.length("b") > 0).distinct()
    # length filter on the whole: a text with more than 1 / t times the longest entry's tokens matches none
    longest = b.agg(F.coalesce(F.max(F.length("b")), F.lit(0)) + 1).scalar()
    a = a.filter((F.length("a") + 1) * F.lit(t) <= longest)
    a = spread(materialise(a))
    ta, tb = a.withColumn("ta", pairs_of(F.col("a"))), b.withColumn("tb", pairs_of(F.col("b")))
    # Global order: rarity on the reference side (tokens it lacks come first: they can't match, so they needn't be joined)
    freq = tb.select(F.explode("tb").alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    ranks = broadcast_if_small(materialise(freq.select("tok", F.struct("df", "tok").alias("ord"))))

    def prefixes(d: DataFrame, text: str, toks: str, keep: str) -> DataFrame:
        """(text, size, token, position, tokens in global order) for each token of the prefix."""
        long = d.select(text, F.col(toks), F.explode(toks).alias("tok")).join(ranks, "tok", keep)
        g = long.groupBy(text).agg(F.first(toks).alias(toks), F.array_sort(F.collect_list(F.coalesce("ord", F.struct(F.lit(0).cast("long").alias("df"), F.col("tok").alias("tok"))))).alias("o"))
        n = F.size(toks)
        pre = F.slice("o", F.lit(1), n - F.ceil(F.lit(t) * n).cast("int") + 1)
        return g.select(text, toks, n.alias("n"), F.posexplode(pre).alias("pos", "x")).select(text, toks, "n", "pos", F.col("x.tok").alias("tok"))

    pa = prefixes(ta, "a", "ta", "left")
    pb = prefixes(tb, "b", "tb", "left").withColumnRenamed("n", "m").withColumnRenamed("pos", "pos_b")
    pb = broadcast_if_small(materialise(pb))
    need = F.ceil(F.lit(t / (1 + t)) * (F.col("n") + F.col("m")) - F.lit(1e-9))
    cand = pa.join(pb, "tok").filter(
        (F.col("m") >= F.lit(t) * F.col("n")) & (F.col("n") >= F.lit(t) * F.col("m"))  # length
        & (1 + F.least(F.col("n") - F.col("pos") - 1, F.col("m") - F.col("pos_b") - 1) + F.least("pos", "pos_b") >= need)  # position
    )
    both = F.size(F.array_intersect("ta", "tb"))
    exact = cand.withColumn("jaccard", both / (F.col("n") + F.col("m") - both)).filter(F.col("jaccard") >= t)
    return exact.select("a", "b", "jaccard").distinct()


# ---------------------------------------------------------------- places

# Words around a place name that name no place, and short forms within place names.
PLACE_NOISE = r"\b(greater|area|city of|city|hq|headquarters|office|remote|hybrid|home based|home|on site|onsite|metro|region|or|near|in)\b"
SHORT_FORMS = {"st": "saint", "ft": "fort", "mt": "mount", "pt": "port", "up": "upper", "n": "new"}
STREET = r"\b\d+[a-z]? [\w' ]*?\b(lane|street|road|avenue|st|rd)\b"


def _expand(c: Column) -> Column:
    for short, long in SHORT_FORMS.items():
        c = F.regexp_replace(c, rf"(^|[ ,/;>\-(]){short}\.? (?=[a-z]{{4,}})", rf"$1{long} ") if short != "n" else F.regexp_replace(c, r"(^|[ ,/;>\-(])n\. (?=[a-z]{4,})", "$1new ")
    return c


def place_segments(c: Column) -> Column:
    """The parts of a folded value between separators, without noise and numbers."""
    v = F.regexp_replace(c, STREET, " , ")
    v = F.regexp_replace(v, r"[,;/>|()\[\]:]| - |\d+|-(?=[a-z]{2}-)|(?<=^[a-z]{2})-|(?<=-[a-z]{2})-", " , ")
    v = F.regexp_replace(v, PLACE_NOISE, " , ")
    parts = F.transform(F.split(v, ","), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"[^\p{L}' \-]+", " "), r" +", " ")))
    return F.filter(parts, lambda x: F.length(x) > 1)


def map_places(df: DataFrame, row_id: str, column: str, ref: DataFrame) -> DataFrame:
    """(row_id, ref_id) of each non-missing value that isn't a label; ref_id 0 where it names no listed city."""
    labels = ref.select(F.col("label").alias("__l")).distinct()
    rows = df.filter(~missing(column)).select(F.col(row_id).alias("row_id"), F.col(column).alias("v")).join(broadcast_if_small(labels), F.col("v") == F.col("__l"), "left_anti")
    vals = materialise(rows.select("v").distinct().withColumn("k", _expand(fold(F.col("v")))))
    keys = materialise(vals.select("k").distinct().withColumn("seg", place_segments(F.col("k"))))
    names = ref.select(
        "place_id", fold(F.col("state")).alias("state"), fold(F.col("state_code")).alias("sc"), fold(F.col("country")).alias("country"), fold(F.col("country_code")).alias("cc"),
        F.explode(F.array_union(F.array("city"), F.coalesce("other_names", F.array().cast("array<string>")))).alias("name"),
    ).withColumn("name", fold(F.col("name"))).filter(F.length("name") > 0)
    regions = names.select(F.explode(F.array("state", "sc", "country", "cc")).alias("r")).filter(F.length("r") > 0)
    keys = spread(keys).withColumn("hints", regions.agg(F.collect_set("r")).scalar())  # the region words of the list
    hints = F.col("hints")
    # a segment of several words may end in region words that no separator divides ("port orroloport ka nv")
    def trail(s: Column) -> Column:
        w = F.split(s, " ")
        cut = F.aggregate(F.reverse(w), F.struct(F.lit(0).alias("n"), F.lit(True).alias("go")), lambda acc, x: F.struct(
            (acc["n"] + F.when(acc["go"] & F.array_contains(hints, x) & (F.length(x) == 2), 1).otherwise(0)).alias("n"),
            (acc["go"] & F.array_contains(hints, x) & (F.length(x) == 2)).alias("go")))["n"]
        head = F.array_join(F.slice(w, F.lit(1), F.size(w) - cut), " ")
        return F.filter(F.concat(F.array(head), F.slice(F.reverse(w), F.lit(1), cut)), lambda x: F.length(x) > 0)

    parts = keys.select("k", "hints", F.flatten(F.transform("seg", trail)).alias("seg")).select("k", "hints", "seg", F.array_intersect("seg", hints).alias("hint"))
    segs = parts.select("k", "hint", F.posexplode_outer(F.filter("seg", lambda x: ~F.array_contains(hints, x))).alias("pos", "s"))
    segs = materialise(segs)
    near = jaccard_join(segs, names, "s", "name")
    size = F.greatest(F.length("a"), F.length("b"))
    dist = F.levenshtein("a", "b")
    # exact check: spellings a few keystrokes apart; a swap of neighbours counts two here
    near = near.withColumn("dist", dist).filter((F.col("dist") <= 1) | (F.col("dist") <= F.ceil(size / 4)) & (F.col("jaccard") >= JACCARD))
    best = near.groupBy("a").agg(F.max(F.struct("jaccard", (-F.col("dist")).alias("d"), "b")).alias("x")).select("a", F.col("x.b").alias("b"), F.col("x.jaccard").alias("j"), (-F.col("x.d")).alias("dist"))
    best = best.withColumnRenamed("a", "sa")
    hits = segs.join(broadcast_if_small(materialise(best)), F.col("s") == F.col("sa"), "left")
    entry = hits.join(broadcast_if_small(names), F.col("b") == F.col("name"), "left")
    agree = F.size(F.array_intersect("hint", F.array("state", "sc", "country", "cc")))
    # region words that contradict the entry: the value names a place of that name elsewhere, which isn't listed
    ok = F.col("place_id").isNotNull() & ((F.size("hint") == 0) | (agree > 0))
    # an unknown two-letter code beside the name is a region that the list doesn't have
    strange = F.max(F.when(F.col("b").isNull() & F.col("s").isNotNull() & (F.length("s") == 2), 1).otherwise(0))
    # an unknown part after the name reads as its region, unless a known region agrees; one before it is a district or a street
    lone = F.max(F.when(F.col("b").isNull() & F.col("s").isNotNull(), F.col("pos")))
    pick = entry.groupBy("k").agg(
        F.max(F.when(ok, F.struct(agree.alias("agree"), F.col("j"), (-F.col("dist")).alias("d"), (-F.col("place_id")).alias("id"), F.col("pos").alias("pos")))).alias("x"), strange.alias("strange"), lone.alias("lone")
    ).select("k", F.when(F.col("x").isNull() | (F.col("strange") > 0) | (F.col("x.agree") == 0) & (F.coalesce("lone", F.lit(-1)) > F.col("x.pos")), F.lit(0)).otherwise(-F.col("x.id")).cast("long").alias("ref_id"))
    chosen = vals.join(pick, "k").select(F.col("v").alias("__v"), "ref_id")
    return rows.join(chosen, F.col("v") == F.col("__v")).select("row_id", "ref_id")


# ---------------------------------------------------------------- kinds of employment

#: Confidence (normal quantile) with which most copies of an opening must show one label beside a value.
SURE = 1.96


def _words(c: Column) -> Column:
    return F.trim(F.regexp_replace(fold(c), r"[^\p{L}\d]+", " "))


def fitted_names(df: DataFrame, column: str, keys: list[Column], ref: DataFrame) -> DataFrame:
    """(name, employment_id): what the entries are called in practice, learnt from copies of one record.

    Rows that share one of ``keys`` are captures of one record. Where one of them has a label and another a free value, they
    name the same entry. A value is a name of the label that it stands with most often, if the lower bound of that share
    (Wilson's interval) is over a half. Rows are summed up by (key, value) first; a record is counted once for a value and a
    label, so no pairs of rows are built and copies of a record don't vouch for each other.
    """
    labels = ref.select("employment_id", _words(F.col("label")).alias("l"))
    rows = df.filter(~missing(column)).select(_words(F.col(column)).alias("k"), F.explode(F.array(*keys)).alias("g")).filter("g is not null")
    rows = materialise(rows.groupBy("g", "k").agg(F.count(F.lit(1)).alias("n")).join(broadcast_if_small(labels), F.col("k") == F.col("l"), "left"))
    stated = rows.filter("employment_id is not null").groupBy(F.col("g").alias("g2")).agg(F.min("employment_id").alias("entry"), F.max("employment_id").alias("last")).filter("entry = last")
    seen = rows.filter("employment_id is null").join(stated, F.col("g") == F.col("g2")).groupBy("k", "entry").agg(F.count(F.lit(1)).alias("n"))
    best = seen.groupBy("k").agg(F.max_by("entry", F.struct("n", -F.col("entry"))).alias("employment_id"), F.max("n").alias("m"), F.sum("n").alias("n"))
    p, z = F.col("m") / F.col("n"), SURE
    low = (p + z * z / (2 * F.col("n")) - z * F.sqrt((p * (1 - p) + z * z / (4 * F.col("n"))) / F.col("n"))) / (1 + z * z / F.col("n"))
    return best.filter((low > 0.5) & (F.length("k") > 0)).select(F.col("k").alias("name"), "employment_id")


def map_employment(df: DataFrame, row_id: str, column: str, ref: DataFrame, keys: list[Column], t: float = 0.5) -> DataFrame:
    """(row_id, ref_id) of each non-missing value that isn't a label; ref_id 0 where it names no entry.

    ``keys``: columns of ``df``'s that are equal on captures of one record and NULL where unknown; see `fitted_names`.
    """
    labels = ref.select(F.col("label").alias("__l")).distinct()
    rows = df.filter(~missing(column)).select(F.col(row_id).alias("row_id"), F.col(column).alias("v")).join(broadcast_if_small(labels), F.col("v") == F.col("__l"), "left_anti")
    told = ref.select(_words(F.col("label")).alias("name"), "employment_id", F.lit(0).alias("r")).union(fitted_names(df, column, keys, ref).withColumn("r", F.lit(1)))
    alias = materialise(told.filter(F.length("name") > 0).groupBy("name").agg(F.min(F.struct("r", "employment_id")).alias("x")).select("name", "x.employment_id"))
    vals = materialise(rows.select("v").distinct().withColumn("k", _words(F.col("v"))))
    # the value as a whole, else each run of up to three of its words, the earliest first
    w = F.split("k", " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.size(w)), lambda i: F.transform(F.array(F.lit(3), F.lit(2), F.lit(1)), lambda n: F.array_join(F.slice(w, i, n), " "))))
    parts = vals.select("k").distinct().select("k", F.posexplode(F.array_distinct(F.concat(F.array("k"), runs))).alias("part", "s"))
    parts = materialise(parts.filter(F.length("s") > 1))
    near = jaccard_join(parts, alias, "s", "name", t)
    # short names must be met exactly: a letter more or less makes another word
    near = near.filter((F.col("a") == F.col("b")) | (F.length("b") > 5) & (F.levenshtein("a", "b") <= F.greatest(F.lit(2), F.floor(F.length("b") / 4))))
    got = parts.join(broadcast_if_small(materialise(near)), F.col("s") == F.col("a")).join(broadcast_if_small(alias), F.col("b") == F.col("name"))
    pick = got.groupBy("k").agg(F.max(F.struct("jaccard", (-F.col("part")).alias("p"), (-F.col("employment_id")).alias("id"))).alias("x")).select(F.col("k").alias("__k"), (-F.col("x.id")).alias("ref_id"))
    chosen = vals.join(pick, F.col("k") == F.col("__k"), "left").select(F.col("v").alias("__v"), F.coalesce("ref_id", F.lit(0)).cast("long").alias("ref_id"))
    return rows.join(chosen, F.col("v") == F.col("__v")).select("row_id", "ref_id")
