"""The manifest against a tree that is built and folded in one loop."""

import hashlib

import pytest
from pyspark.sql import functions as F

from offerwell.llm import manifest

SCHEMA = "doc_id long, source string, leaf string, found string, name string, g long, proof string, root string, at long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def climb(nodes, fanout, steps):
    """Root of (digest, row numbers) nodes; the siblings met by every row are added to ``steps``."""
    while len(nodes) > 1:
        above = []
        for i in range(0, len(nodes), fanout):
            run = nodes[i : i + fanout]
            for j, (_, rows) in enumerate(run):
                for r in rows:
                    steps[r].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1 :])))
            above.append((sha("".join(d for d, _ in run)), [r for _, rows in run for r in rows]))
        nodes = above
    return nodes[0]


def brute(rows, fanout):
    rows = sorted(rows, key=lambda r: ((r[1] is not None, (r[1] or "").encode()), (r[0] is not None, r[0] or 0), r[2], r[3] or ""))
    steps, groups = [[] for _ in rows], {}
    for i, r in enumerate(rows):
        groups.setdefault(r[1], []).append((r[2], [i]))
    tops = [climb(nodes, fanout, steps) for nodes in groups.values()]
    subroot = {i: top for top, members in tops for i in members}
    root = climb(tops, fanout, steps)[0] if tops else None
    out = []
    for i, (key, group, leaf, found) in enumerate(rows):
        folded = found or leaf
        for a, b in steps[i]:
            folded = sha(a + folded + b)
        out.append((key, group, leaf, subroot[i], root, sha("".join(a + b for a, b in steps[i])), folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], SCHEMA)
    made = manifest.manifest(df, check="found", **options).collect()
    return made, sorted([tuple(r[c] for c in ("doc_id", "source", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in made], key=str)


def rows_of(sizes):
    out, k = [], 0
    for group, n in sizes.items():
        for i in range(n):
            leaf = sha(f"{group}{i}")
            out.append((k * 7 % 1000, group, leaf, sha("other") if k % 5 == 0 else leaf if k % 5 == 1 else None))
            k += 1
    return out


@pytest.mark.parametrize("sizes,fanout,levels", [
    ({"a": 100, "b": 1, None: 5, "": 9, "zé": 28, "c": 3, "d": 2}, 3, 1),
    ({"a": 40, "b": 11, None: 7, "ab": 1}, 2, 2),
    ({"only": 30}, 3, 1),
    ({None: 1}, 3, 7),
    ({f"s{i}": 1 + i % 3 for i in range(30)}, 3, 7),
    ({"a": 55, "b": 16}, 4, 1),
])
def test_equals_one_loop(spark, sizes, fanout, levels):
    rows = rows_of(sizes)
    assert run(spark, rows, fanout=fanout, levels=levels)[1] == brute(rows, fanout)


def test_ties_nulls_repeated_rows(spark):
    rows = [(None, "s", sha("n"), None)] * 2 + [(1, "s", sha(str(i)), None) for i in range(5)] + [(2, "s", sha("r"), None)] * 20 + [(None, None, sha("z"), None)] * 4
    made, got = run(spark, rows, levels=1, proofs=True)
    assert got == brute(rows, 3) and all(r[-1] for r in got)
    for r in made:  # the proof itself leads from the leaf to the root
        digest = r["leaf"]
        for step in r["proof"]:
            digest = sha(step["left"] + digest + step["right"])
        assert digest == r["root"]
    assert sorted(r["position"] for r in made if r["source"] == "s") == list(range(27))


def test_empty_table(spark):
    assert run(spark, [])[1] == []


def test_row_digest(spark):
    df = spark.createDataFrame([(1, None, "é\n"), (None, "", "")], "a long, b string, c string")
    got = [r[0] for r in df.select(manifest.row_digest(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == [sha("1:1-3:é\n"), sha("-0:0:")]
