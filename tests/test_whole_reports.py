"""Reports and payloads of all ids, chunks and words."""

from quillspark.queries import QUERIES


def test_nothing_is_left_out(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = [(r.source, r.doc_id) for r in QUERIES["top03_sorted_ids_whole"](spark, folder).collect()]
    assert {i for _, i in ids} == set(docs) and ids == sorted(ids)
    assert QUERIES["fn06_point_payload_whole"](spark, folder).count() == sum(x.count("\n") + 1 for x in docs.values())
    assert QUERIES["fn20_token_index_whole"](spark, folder).count() == sum(len(x.split(" ")) for x in docs.values())
