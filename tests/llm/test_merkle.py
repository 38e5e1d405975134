import hashlib
import zlib

from pyspark.sql import functions as F

from quillspark.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, root int, tree string, kept0 string"
NAMES = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """(root, each node's list of siblings from below)."""
    proofs, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, place in enumerate(places):
            if place ^ 1 < len(nodes):
                proofs[k].append(nodes[place ^ 1])
        nodes, places = [digest(*nodes[k : k + 2]) for k in range(0, len(nodes), 2)], [p >> 1 for p in places]
    return nodes[0], proofs


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0], leaf(row)))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    subroots, found = [], []
    for name in names:
        groups[name].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        root, proofs = climb([x[1] for x in groups[name]])
        subroots.append(root)
        found.append((name, proofs))
    root, above = climb(subroots)
    return sorted(
        ((i, h, sub, root, digest(*(below + more))) for (name, proofs), sub, more in zip(found, subroots, above, strict=True)
         for (i, h), below in zip(groups[name], proofs, strict=True)), key=repr,
    )


def manifest(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA)
    out = merkle_manifest(frame, NAMES, keep={"note": F.length("text")})
    return out.withColumn("sha", proof_digest(F.col("proof"))).withColumn("folded", fold(F.col("leaf"), F.col("proof")))


def check(spark, rows):
    got = manifest(spark, rows).collect()
    assert sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.sha) for r in got), key=repr) == brute(rows)
    assert all(r.folded == r.root for r in got)


def test_groups_of_all_sizes_and_odd_values(spark):
    rows = [(k, f"s{k % 3}", "en", k, f"text {k}") for k in range(2_500)]  # more than one block, and a ragged end
    rows += [(k, None, "de", None, None) for k in range(9_000, 9_005)] + [(7, "a", "Ä", 0, ""), (None, "b", "z", 1, "é" * 50_000)]
    rows += [(k, "n", None, 2, "ü") for k in (4, 1, 9)] + [(1, "n", "", 2, "empty name"), (12, "x", "en", 1, "again"), (12, "x", "en", 1, "again")]
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(1, "a", "en", 1, "only")])
    check(spark, [(1, "a", "en", 1, "one"), (1, "a", "en", 1, "two"), (5, "b", "fr", None, "three")])
    assert manifest(spark, []).collect() == []


def test_tampering_is_found(spark):
    rows = [(k, "s", "en" if k % 3 else "fr", 5, "text") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    count = F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    checked = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), count, F.col("text"))
    out = merkle_manifest(frame, NAMES, keep={"checked": checked}).withColumn("folded", fold(F.col("checked"), F.col("proof")))
    for r in out.collect():
        assert (r.folded == r.root) == (zlib.crc32(str(r.doc_id).encode()) % 7 != 0)
