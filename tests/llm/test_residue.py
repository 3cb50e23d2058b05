import pytest

from sieveworks.llm import residue

BAD = ["Loading…", "Welcome to {{ job.team }}, we are glad you found us.", "A null day starts with seed orders.", "xxx xx xxxx xxx", "Lorem ipsum dolor amet velo porta donec", "HTTP 503 Bad Gateway", "Please turn on JavaScript to view this page.", "404 - Not Found", "test test test", "Good posting text here.\nDescription goes here.", "We offer [Insert benefits here] and more.", "Seite nicht gefunden", "Your session has expired. Sign in once more to go on."]
GOOD = ["Error Analyst", "JavaScript Developer", "Loading Bay Supervisor", "You answer calls when a page is not found or a session expires.", "Mail merges with %JOB_TITLE% fields are part of the daily work.", "Pay steps run from {A} to {D} in our own scheme.", "You replace lorem ipsum drafts with real copy before budget sheets go out.", "Solid JavaScript is required to work on test rigs.", "", None, "   "]
# Not among the exemplars: other words, other orders, other filler.
HELD_OUT = [
    "JavaScript must be enabled to use this website", "This application requires JavaScript. Please activate it in your browser.", "Your browser must allow scripts to display this vacancy", "Allow JavaScript to continue",
    "Sorry, the page you requested was not found", "500 Internal Server Error", "HTTP 502: bad gateway", "Oops! Something went wrong, please try again later", "Access to this page was denied", "Your session expired, please log in again",
    "Vestibulum ante urna faucibus orci luctus et ultrices posuere", "Curabitur velit nunc sodales tempor, eget lacus magna", "sdfg hjkl asdf wert", "Enter your job description here", "Replace this text", "Placeholder text", "Kindly wait while the page is loading",
    "Dear ${applicant_name}, thank you.", "Our <% company %> team", "Reports to @@manager@@ each week", "at org.site.view.Render.run(Render:88)", "Test test, please ignore", "Loading, please wait",
]
LOOK_ALIKES = ["You repair scripts and pages of our intranet for the northern crew.", "The server room is part of your daily round.", "You enter orders in the log and replace worn parts.", "Our magnetic tempo sensors need a careful hand and a sense of curiosity.", "You see to it that no error is left in the crew lists before loading starts."]


def corpus(spark, rows):
    filler = [(1000 + i, "Harbour Clerk", f"You will sort seed orders with the data group. We work on test rigs, and people here wait for loading plans {i}.") for i in range(300)]
    return spark.createDataFrame(rows + filler, "row_id long, title string, description string")


def test_cases(spark):
    df = corpus(spark, [(i, "Clerk", t) for i, t in enumerate(BAD)] + [(100 + i, t, t) for i, t in enumerate(GOOD)])
    got = {(r.row_id, r.field) for r in residue.find_residue(df, "row_id", ["title", "description"]).collect()}
    assert got == {(i, "description") for i in range(len(BAD))}


def test_held_out_wording(spark):
    assert not set(HELD_OUT) & set(residue.RESIDUE)
    df = corpus(spark, [(i, "Clerk", t) for i, t in enumerate(HELD_OUT)] + [(500 + i, "Clerk", t) for i, t in enumerate(LOOK_ALIKES)])
    got = {r.row_id for r in residue.find_residue(df, "row_id", ["title", "description"]).collect()}
    assert len([i for i in got if i < 500]) >= 0.8 * len(HELD_OUT) and not [i for i in got if i >= 500]


def test_empty_and_long(spark):
    df = spark.createDataFrame([], "row_id long, title string, description string")
    assert residue.find_residue(df, "row_id", ["title", "description"]).collect() == []
    long = "seed orders and test rigs " * 20_000
    df = corpus(spark, [(1, None, long), (2, None, long + "\n{{ name }}"), (2, None, long + "\n{{ name }}")])
    assert [r.row_id for r in residue.find_residue(df, "row_id", ["title", "description"]).collect()] == [2, 2]


@pytest.mark.parametrize(("text", "marks"), [("{{a}} ${b} <%= c %> <<D>> ||E|| $$f$$ @@g@@ __H__ %I_J% [CITY] {0}", 11), ("a | b || c, 5% off, [more], {A}", 0)])
def test_marks(text, marks):
    assert residue.tokens(text).count("<field>") == marks
