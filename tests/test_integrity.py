from lamina.operators.integrity import duplicate_keys, duplicate_summary, orphan_summaries, orphan_summary, orphans
from lamina.plans import checks


def test_duplicates(rows):
    df = rows("a string, b string", ("x", None), ("x", None), ("x", "y"), ("z", "y"), ("x", None))
    assert [tuple(r) for r in duplicate_keys(df, ["a", "b"]).collect()] == [("x", None, 3)]
    summary = duplicate_summary(df, "t", ["a", "b"]).first()
    assert tuple(summary) == ("t", "a,b", 1, 2)
    assert tuple(duplicate_summary(df.limit(0), "t", ["a"]).first()) == ("t", "a", 0, 0)


def test_orphans(rows):
    child = rows("p string", ("x",), ("gone",), ("gone",), (None,))
    parent = rows("id string", ("x",))
    assert [tuple(r) for r in orphans(child, "p", parent, "id").collect()] == [("gone", 2)]
    assert tuple(orphan_summary(child, "c", "p", parent, "parents").first()) == (
        "c", "p", "parents", 1, 2)


def test_orphans_of_many_references(rows):
    """The same as one by one, and no parent's keys go to the driver for a broadcast."""
    tables = {
        "a": rows("p string, q string", ("x", "y"), ("gone", "y"), ("gone", None), (None, "lost")),
        "b": rows("p string", ("y",), ("z",), ("x",)), "none": rows("p string"),
        "p1": rows("id string", ("x",), ("x",), (None,)), "p2": rows("id string", ("y",)),
    }
    references = [("a", "p", "p1"), ("a", "q", "p2"), ("b", "p", "p1"), ("b", "p", "p2"), ("none", "p", "p1"), ("a", "q", "none")]
    tables["none"] = tables["none"].withColumn("id", tables["none"]["p"])
    found = orphan_summaries(references, tables)
    assert [tuple(r) for r in found.collect()] == [
        tuple(orphan_summary(tables[c], c, k, tables[p], p).first()) for c, k, p in references]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and not [x for x in plan.splitlines() if "Broadcast" in x and "LeftAnti" in x]


def test_duplicate_hashes(rows):
    df = rows("_row_hash string", ("a",), ("a",), ("b",))
    found = {r.table_name: (r.value, r.ok) for r in
             checks.unique_hashes({"t": df, "u": df.where("_row_hash = 'b'")}).collect()}
    assert found == {"t": (1.0, False), "u": (0.0, True)}
