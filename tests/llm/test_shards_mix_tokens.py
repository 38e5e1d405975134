"""Operators 7, 8 and 10."""

import math
import zlib
from collections import Counter

import numpy as np

from quillspark.llm.common import new_path
from quillspark.llm.mixing import mix_sources, replicate, source_rates
from quillspark.llm.sharding import Leaf, assign_shards, grown, layout, shard_documents
from quillspark.llm.token_counts import SEPARATOR, count_tokens, scan_token_files, write_token_files


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, _region string, _count int")


def test_shards_laws(spark):
    rows = [(k, None if k % 50 == 0 else f"text é {k}" * (k % 3), "s", "mine", 5) for k in range(4000)]
    out = [r.asDict() for r in shard_documents(docs_of(spark, rows)).collect()]
    assert len(out) == 4000 and {r["law"] for r in out} == {"key"}
    for r in out:
        text = (rows[r["doc_id"]][1] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 16, zlib.crc32(text))
        assert r["grown_shard"] == r["shard"] or r["grown_shard"] == 40
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    assert max(map(len, slots.values())) < 160
    moved = sum(r["grown_shard"] == 40 for r in out)
    assert 50 < moved < 160


def test_shard_movement_stays_in_the_changed_subtree(spark):
    docs = docs_of(spark, [(k, "t", "s", "mine", 5) for k in range(3000)])
    tree = layout(16)
    heavy = [Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    both = assign_shards(assign_shards(docs, tree), heavy, shard="later")
    assert both.columns == [*docs.columns, "shard", "later"] and both.first()._region == "mine"
    for row in both.where("shard <> later").collect():
        changed = [x for x in tree if x.shard == row.later][0]
        assert changed.region == 0  # region 0 grew: rows enter it, and within it move only to what grew
        if row.shard < 8:
            assert row.later == 5 or (changed.rack == 1 and row.shard < 4)
    assert {x.shard for x in grown(tree)} == set(range(17))


def test_shard_cases(spark):
    docs = docs_of(spark, [(None, "a", "s", "", 1), (None, "b", "s", "", 1), (1, "x", "s", "", 1), (1, "x", "s", "", 1), (2, "y" * 300_000, "s", "", 1)])
    out = shard_documents(docs, shards=3).collect()
    assert len(out) == 5 and len({r.shard for r in out if r.doc_id == 1}) == 1 and len({(r.shard, r.slot) for r in out}) == 5
    assert shard_documents(docs.limit(0)).count() == 0


def test_mixture_rates_and_counts(spark):
    rows = [(k, "t", "big" if k % 10 else ("small" if k % 20 else None), "m", 7) for k in range(6000)]
    docs = docs_of(spark, rows)
    rates = {r.source: r for r in source_rates(docs, temperature=0.0).collect()}
    assert all(abs(r.share - 1 / 3) < 1e-9 for r in rates.values()) and abs(rates["big"].rate - 2000 / 5400) < 1e-9
    out = mix_sources(docs, temperature=0.0)
    assert out.columns == [*docs.columns, "copy", "shuffle_key"] and out.first()._count == 7
    got = out.collect()
    assert [r.shuffle_key for r in got] == sorted(r.shuffle_key for r in got)
    sizes = Counter(r.source for r in got)
    assert all(abs(n - 2000) < 5 * math.sqrt(2000 * 7) for n in sizes.values())
    assert [tuple(r) for r in got] == [tuple(r) for r in mix_sources(docs.repartition(7), temperature=0.0).collect()]


def test_poisson_inversion(spark):
    docs = docs_of(spark, [(k, "t", "s", "m", 1) for k in range(4000)])
    for rate in (0.0, 0.7, 3.0, 40.0):
        rates = spark.createDataFrame([("s", rate)], "source string, rate double")
        counts = Counter(r.doc_id for r in replicate(docs, rates).select("doc_id").collect())
        n = np.array([counts[k] for k in range(4000)])
        assert abs(n.mean() - rate) < 5 * math.sqrt(rate / 4000) + 1e-9
        assert abs(n.var() - rate) < 0.15 * rate + 1e-9
        for k in range(6):  # shares of each count against the distribution's own
            chance = math.exp(-rate) * rate**k / math.factorial(k)
            assert abs(int((n == k).sum()) - 4000 * chance) <= 5 * math.sqrt(4000 * chance * (1 - chance)) + 1e-9


def test_mixture_cases(spark):
    docs = docs_of(spark, [(None, None, None, "m", 1), (1, "", "a", "m", 1), (1, "", "a", "m", 1), (2, "x" * 100_000, "b", "m", 1)])
    out = mix_sources(docs, weights={"a": 1.0}, budget=400.0).collect()
    assert {r.source for r in out} == {"a"} and len(out) % 2 == 0 and len(out) > 200
    assert mix_sources(docs.limit(0)).count() == 0


def test_token_files_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).repartition(3)
    more = spark.createDataFrame([(900, None), (901, ""), (None, "a b"), (902, "<|endoftext|> x"), (902, "<|endoftext|> x"), (903, "ab " * 90_000 + "\n\n" * 99)], "doc_id long, text string")
    docs = docs.select("doc_id", "text").unionByName(more)
    import base64

    import tiktoken

    from quillspark.llm.token_counts import CUT

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open("/opt/tokenizers/byte_bpe_50k.tiktoken", "rb"))}
    encoder = tiktoken.Encoding("whole", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
    want = sorted(((r.doc_id, len(encoder.encode_ordinary(r.text or ""))) for r in docs.collect()), key=str)
    assert sorted((tuple(r) for r in count_tokens(docs).collect()), key=str) == want
    assert count_tokens(docs.limit(0)).count() == 0
    folder = new_path(spark, "tokens")
    manifest = write_token_files(docs, folder)
    for size in (2, 16, 1 << 20):  # documents over very many blocks, and many documents in one
        found = scan_token_files(spark, folder, block_bytes=size) if size > 2 else scan_token_files(spark, folder, block_bytes=64)
        joined = manifest.join(found.drop("start", "terminated"), ["file", "ordinal"])
        assert sorted(((r.doc_id, r.n_tokens) for r in joined.collect()), key=str) == want


def test_scan_of_foreign_files(spark, tmp_path):
    ids = [SEPARATOR, 1, 2, SEPARATOR, SEPARATOR, 3, 4, 5]
    (tmp_path / "a.bin").write_bytes(np.array(ids, dtype="<u2").tobytes() + b"\x01")
    (tmp_path / "b.bin").write_bytes(b"")
    for size in (2, 4, 6, 1024):
        got = scan_token_files(spark, str(tmp_path), block_bytes=size).orderBy("ordinal").collect()
        assert [(r.file, r.ordinal, r.start, r.n_tokens, r.terminated) for r in got] == [
            ("a.bin", 0, 0, 0, True), ("a.bin", 1, 1, 2, True), ("a.bin", 2, 4, 0, True), ("a.bin", 3, 5, 3, False),
        ]
