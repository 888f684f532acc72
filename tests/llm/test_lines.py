from pyspark.sql import functions as F

from msalake.llm import lines


def test_spread(documents):
    rows = [(i, f"own line {i}\n  shared footer \nend {i}\n\n", f"site{i % 12}") for i in range(60)]
    rows += [(100 + i, "same site only\nown", "site1") for i in range(40)] + [(200, None), (201, ""), (202, "shared footer", None), (202, "shared footer", None)]
    rows += [(300 + i, "nine sites\nx%d" % i, f"site{i}") for i in range(9)]
    out = lines.clean(documents(*rows).withColumn("_pos", F.lit(7)).drop("_pos"))
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows)
    assert got[5].text == "own line 5\nend 5\n\n" and got[5].n_removed == 1 and got[5].n_lines == 5 and got[5].n_chars == len(got[5].text)
    assert got[110].text == "same site only\nown" and got[305].n_removed == 0
    assert got[200].text is None and got[200].n_lines == 0 and got[201].text == "" and got[202].text == ""


def test_threshold_is_exact(documents):
    """Around the threshold the exact count decides."""
    rows = [(s * 1000 + i, f"line with {s} sites", f"site{i}") for s in (8, 9, 10, 11, 30, 300) for i in range(s)]
    kept = {r.doc_id // 1000: r.text for r in lines.clean(documents(*rows)).collect()}
    assert {s: bool(t) for s, t in kept.items()} == {8: True, 9: True, 10: False, 11: False, 30: False, 300: False}


def test_rows_without_an_id_of_their_own(documents):
    """Marks belong to a row: other rows of its id keep their lines, and rows without an id are cleaned too."""
    rows = [(i, f"own {i}\nshared footer", f"site{i}") for i in range(12)]
    rows += [(7, "first line stays\nsecond line stays", "site1"), (None, "a\nshared footer\nb", "site2"), (None, "shared footer\nc\nd", "site3")]
    out = lines.clean(documents(*rows)).collect()
    assert sorted(r.text for r in out if r.doc_id == 7) == ["first line stays\nsecond line stays", "own 7"]
    assert sorted((r.text, r.n_removed) for r in out if r.doc_id is None) == [("a\nb", 1), ("c\nd", 1)]


def test_empty(documents):
    assert lines.clean(documents((1, "a")).limit(0)).count() == 0
