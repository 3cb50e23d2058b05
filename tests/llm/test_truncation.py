import random

from sieveworks.llm import truncation

WORDS = ["sort", "repair", "label", "check"]
THINGS = ["seed orders", "crew lists", "test rigs", "menu cards"]


def text(rnd):
    lines = [f"You will {rnd.choice(WORDS)} {rnd.choice(THINGS)} with the data group every week. Together with the night crew you {rnd.choice(WORDS)} {rnd.choice(THINGS)} before each audit." for _ in range(3)]
    return "\n".join([*lines, *[f"- {rnd.choice(WORDS).title()} {rnd.choice(THINGS)} twice a month" for _ in range(3)]])


def test_held_out_accuracy(spark):
    rnd = random.Random(8)
    rows = [(i, text(rnd), rnd.choice(["en", "en-GB"]), "s") for i in range(400)]
    cut = set(range(0, 400, 8))
    body = lambda t: t[: t.index("\n- ")]
    rows = [(i, body(t)[: rnd.randint(60, len(body(t)) - 12)].rstrip(". ") if i in cut else t, g, s) for i, t, g, s in rows]
    rows += [(900, None, "en", "s"), (901, "  \n ", "en", "s"), (902, rows[1][1] + "\n\n", None, None), (903, rows[1][1] + " and then [truncated]", "en", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = truncation.scores(df, "doc_id", "text", "lang", "source").collect()
    found = {r.row_id for r in got if r.cut}
    assert {900, 901}.isdisjoint(r.row_id for r in got) and 903 in found
    hit = len(found & cut)
    assert hit >= 0.85 * len(cut) and len(found - cut - {903, 902}) <= 5


def test_limits_and_empty(spark):
    rows = [(i, "x" * 50 if i < 30 else "x" * (100 + i), "en", "s") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [(r.s, r.size) for r in truncation.field_limits(df, "text", "source").collect()] == [("s", 50)]
    assert truncation.scores(df.filter("doc_id < 0"), "doc_id", "text", "lang", "source").collect() == []


def test_other_contexts_leave_scores_alone(spark):
    """Millions of contexts of another language, as many lines as before, don't change what is known of an ending."""
    rnd = random.Random(5)
    rows = [(i, text(rnd) + f"\n- {''.join(rnd.choices('abcdefghij', k=14))}", "en", "s") for i in range(200)]
    noise = [(1000 + i, "\n".join("".join(rnd.choices("klmnopqrstuvwxyzäöüßéèñ", k=60)) for _ in range(150)), "fr", "n") for i in range(300)]
    kind = "doc_id long, text string, lang string, source string"
    alone, among = ({r.row_id: r.score for r in truncation.scores(spark.createDataFrame(x, kind), "doc_id", "text", "lang", "source").collect() if r.row_id < 1000} for x in (rows, rows + noise))
    assert len(among) == 200 and max(abs(among[i] - alone[i]) for i in alone) < 1
