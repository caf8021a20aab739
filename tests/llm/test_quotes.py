import pytest

from pageloom.llm.queries import QUERIES
from pageloom.llm.quotes import unquote

SCHEMA = "conv_id long, turn long, text string, parent string, own_text string, level string"


def run(spark, rows):
    df = spark.createDataFrame([(c, t, x, "a", "b", "c") for c, t, x in rows], SCHEMA)
    return {(r.conv_id, r.turn, r.own_text): r for r in unquote(df).collect()}


@pytest.fixture(scope="module")
def mails(spark):
    return run(spark, [
        (1, 0, "Hello there,\nhow are you?\n\nSecond part"),
        (1, 1, "Fine.\n\nOn Monday A wrote:\n> hello THERE, how\n> are   you?\n"),
        (1, 2, "> > Hello there,\n>> how are you?\n>\n> Fine.\r\nGood to hear\n"),
        (1, 3, "> Second part\nabout this"),
        (1, 4, "> never said\nnothing"), (1, 5, "> > Fine.\n\ndeep only"), (1, 6, "> deep only\n> > > Fine.\nlast"),
        (1, 7, "> last\n\n\n"), (2, 1, "> Hello there,\n> how are you?\nother conversation"),
        (3, 0, None), (3, 1, ""), (3, 2, "a > b\n    > code"), (3, 2, "same turn"), (3, 2, "same turn"), (3, 4, "> same turn\nx"), (3, 5, "> x\ny"), (3, 6, "> z\nz"),
        (None, 0, "n"), (None, 1, "> n\nm"), (4, None, "> q\nq"), (5, 0, "> " * 3000 + "deep\n" + "line\n" * 3000)])


def test_links(mails):
    by = {(c, t): r for (c, t, _), r in mails.items()}
    shape = lambda k: tuple(by[k])[2:7]  # noqa: E731  parent, thread, depth, quotes, linked
    assert shape((1, 0)) == (None, 0, 0, 0, 0)
    assert shape((1, 1)) == (0, 0, 1, 1, 1) and by[1, 1].own_text == "Fine."
    assert shape((1, 2)) == (1, 0, 2, 2, 2) and by[1, 2].own_text == "Good to hear"
    assert shape((1, 3)) == (0, 0, 1, 1, 1) and by[1, 3].own_text == "about this"
    assert shape((1, 4)) == (None, 4, 0, 1, 0)
    assert shape((1, 5)) == (1, 0, 2, 1, 1)
    assert shape((1, 6)) == (5, 0, 3, 2, 2)
    assert shape((1, 7)) == (6, 0, 4, 1, 1) and by[1, 7].own_text == ""
    assert shape((2, 1)) == (None, 1, 0, 1, 0)


def test_edge_cases(mails):
    own = {(c, t): sorted(r.own_text for (a, b, _), r in mails.items() if (a, b) == (c, t)) for c, t, _ in mails}
    assert own[3, 0] == own[3, 1] == [""]
    assert own[3, 2] == ["a > b\n> code", "same turn"] or own[3, 2] == ["a > b\n    > code", "same turn"]
    by = {(c, t): r for (c, t, _), r in mails.items()}
    assert by[3, 4].parent_turn == 2 and by[3, 5].depth == 2 and by[3, 6].parent_turn is None
    assert by[None, 1].parent_turn is None and by[None, 1].own_text == "m" and by[4, None].parent_turn is None
    assert by[5, 0].n_quotes == 1 and by[5, 0].own_text.count("line") == 3000
    assert len(mails) == 20


def test_long_chain(spark):
    rows = [(9, t, f"text {t}\n" + (f"> text {t - 1}" if t else "")) for t in range(37)]
    got = {t: (r.parent_turn, r.thread, r.depth) for (_, t, _), r in run(spark, rows).items()}
    assert got == {t: (t - 1 if t else None, 0, t) for t in range(37)}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_no_python_in_the_plan(spark, capsys):
    QUERIES["op1_quotation_linking"](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
