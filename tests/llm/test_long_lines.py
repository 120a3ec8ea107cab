"""Long passages recur from two documents on."""

from odgraph.llm import linededup


def _long(head, n=60):
    return " ".join(f"{head}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))


def test_a_long_line_of_two_documents_goes_from_the_second(spark):
    near = _long("p").replace("pgb", "other")
    rows = [(1, f"own one\n{_long('q')}\nshort line here"), (2, f"{_long('q')}\nown two\nshort line here"),
            (3, f"{_long('p')}\nown three"), (4, f"own four\n{near}"), (5, f"{_long('r')}\n{_long('r')}"), (6, _long("s", 50)),
            (7, _long("s", 50)), (8, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup_lines(df).collect()}
    want = {i: (t, 0) for i, t in rows}
    want[2] = ("own two\nshort line here", 1)
    want[4] = ("own four", 1)
    assert got == want
    # without a bound of their own long lines recur as others do
    assert {r.doc_id: (r.text, r.n_dropped) for r in linededup.dedup_lines(df, long_words=None).collect()} == {i: (t, 0) for i, t in rows}
