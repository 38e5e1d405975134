"""Queries of the subpackage over the given tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.collocations import collocations
from quillspark.llm.decontamination import benchmark_hits
from quillspark.llm.html_blocks import extract_main_text
from quillspark.llm.line_dedup import duplicate_lines
from quillspark.llm.merkle import fold, leaf_digest, merkle_manifest, proof_digest
from quillspark.llm.mixing import mix_sources
from quillspark.llm.near_dup import near_duplicates
from quillspark.llm.nearest import nearest_neighbours
from quillspark.llm.ngram_join import ngram_components
from quillspark.llm.quotes import as_mail, link_quotes, reply_order
from quillspark.llm.sharding import shard_documents
from quillspark.llm.token_counts import count_tokens
from quillspark.llm.toxicity import score_toxicity


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def op1_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents on sets of four-word shingles."""
    return near_duplicates(_read(spark, folder, "documents"), width=4, percent=80)


def op2_weakly_supervised_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels that are not held out."""
    return score_toxicity(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


def op3_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """Reply order of all conversations, found from quotations alone.

    The turns are first written as mails that quote one another; the order in
    which they answer is then read back from those quotations.
    """
    mails = as_mail(_read(spark, folder, "conversations"))
    found = reply_order(link_quotes(mails, scope_col="scope"))
    return found.select(
        F.col("scope").alias("conv_id"), "message_id", "parent_id", "root_id", "depth", "position", "quote_levels",
        F.md5(F.col("own_text").cast("binary")).alias("own_md5"),
    )


def op4_segment_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all documents that repeat an earlier line up to one edit."""
    return duplicate_lines(_read(spark, folder, "documents"))


def op4_growing_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all documents that repeat an earlier line up to a number of edits that grows with their length."""
    return duplicate_lines(_read(spark, folder, "documents"), growing=True)


def op5_block_rule_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of all pages."""
    return extract_main_text(_read(spark, folder, "pages"))


def op6_projection_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of all vectors for each whose id is divisible by 20."""
    return nearest_neighbours(_read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_hash_tree_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Shards 0 to 39 of all documents, law ``key``."""
    return shard_documents(_read(spark, folder, "documents"), shards=40)


def op8_separator_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of all documents, counted between separators of flat token files."""
    return count_tokens(_read(spark, folder, "documents"))


def op9_simhash_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in all documents, each with its best window."""
    return benchmark_hits(_read(spark, folder, "documents"), _read(spark, folder, "benchmark")).drop("distance")


def op10_poisson_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Copies of all documents mixed by the square root of their source's size, in shuffled order.

    Sizes are counted from the texts. Whole rows are shuffled: a missing
    ``n_chars`` is counted from the text that arrives.
    """
    mixed = mix_sources(_read(spark, folder, "documents"), size=F.coalesce(F.length("text"), F.lit(0)), temperature=0.5)
    return mixed.select("doc_id", "source", F.coalesce("n_chars", F.length("text")).alias("n_chars"), "copy", "shuffle_key")


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Digest, roots and proof of all documents; where 7 divides the id's CRC-32 the checked row has one character more."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    touched = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    count = F.when(touched, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    checked = leaf_digest(*(count if c == "n_chars" else F.col(c) for c in names))
    found = merkle_manifest(_read(spark, folder, "documents"), names, keep={"checked": checked})
    found = found.withColumn("folded_root", fold(F.col("checked"), F.col("proof")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The first 2,000 collocations of two and three words in each language of all documents."""
    return collocations(_read(spark, folder, "documents"), longest=3, least=10, covered=50, top=2000)


def op13_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of all documents whose sets of three-word shingles are similar at 0.9 or more."""
    return ngram_components(_read(spark, folder, "documents"), width=3, percent=90)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_minhash_near_dedup": op1_minhash_near_dedup,
        "op2_weakly_supervised_toxicity": op2_weakly_supervised_toxicity,
        "op3_quotation_linking": op3_quotation_linking,
        "op4_segment_line_dedup": op4_segment_line_dedup,
        "op4_growing_line_dedup": op4_growing_line_dedup,
        "op5_block_rule_html": op5_block_rule_html,
        "op6_projection_neighbours": op6_projection_neighbours,
        "op7_hash_tree_shards": op7_hash_tree_shards,
        "op8_separator_token_counts": op8_separator_token_counts,
        "op9_simhash_decontamination": op9_simhash_decontamination,
        "op10_poisson_mixture": op10_poisson_mixture,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_ngram_jaccard_join": op13_ngram_jaccard_join,
    }


_OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN coalesce(len(ws), 0) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * c >= 80 * (nx.k + ny.k - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (
  SELECT doc_id AS root, doc_id AS node FROM documents
  UNION
  SELECT r.root, e.y FROM r JOIN e ON e.x = r.node)
SELECT r.root AS doc_id, coalesce(any_value(n.k), 0) AS n_shingles, min(r.node) AS component_id,
  r.root = min(r.node) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.root GROUP BY r.root
"""


#: A draw of the hash tree: 52 bits of the MD5 of id and place, as a number in (0, 1).
_DRAW = "((('0x' || substr(md5(d.doc_id || '|' || {place}), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0"

_OP7 = f"""
WITH steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
    b::BIGINT) ORDER BY b) AS t FROM range(256) r(b)),
sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents),
summed AS (
  SELECT doc_id, size, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM sized, steps),
ids AS (SELECT DISTINCT doc_id FROM documents),
r AS (
  SELECT d.doc_id, g.n, arg_min(c.r, (-ln({_DRAW.format(place="'r' || c.r")}) / least(8, 40 + g.n - c.r * 8), c.r)) AS region
  FROM ids d, range(2) g(n), range(6) c(r) WHERE c.r < 5 + g.n GROUP BY 1, 2),
k AS (
  SELECT d.doc_id, d.n, d.region, arg_min(c.k, (-ln({_DRAW.format(place="'k' || d.region || '.' || c.k")}), c.k)) AS rack
  FROM r d, range(2) c(k) WHERE d.region < 5 OR c.k = 0 GROUP BY 1, 2, 3),
s AS (
  SELECT d.doc_id, d.n, arg_min(c.s, (-ln({_DRAW.format(place="'s' || d.region || '.' || d.rack || '.' || c.s")}), c.s)) AS shard
  FROM k d, range(41) c(s) WHERE c.s // 8 = d.region AND c.s % 8 // 4 = d.rack GROUP BY 1, 2)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard::INTEGER AS shard, b.shard::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY a.shard ORDER BY md5(doc_id::VARCHAR), doc_id, size, text_crc32) - 1 AS slot
FROM summed JOIN s a USING (doc_id) JOIN s b USING (doc_id) WHERE a.n = 0 AND b.n = 1
"""

_OP10 = """
WITH sizes AS (SELECT source, sum(coalesce(n_chars, 0))::DOUBLE AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate
  FROM sizes WHERE size > 0),
steps AS (
  SELECT source, list(below ORDER BY k) AS steps FROM (
    SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
    FROM rates, range(96) r(k)) GROUP BY source),
drawn AS (
  SELECT doc_id, d.source, n_chars, len(list_filter(steps, lambda step: step <=
    ((('0x' || substr(md5('17|' || doc_id || '|1'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)) AS n
  FROM documents d JOIN steps s ON s.source IS NOT DISTINCT FROM d.source)
SELECT doc_id, source, n_chars, copy::INTEGER AS copy, md5('order17|' || doc_id || '|' || copy) AS shuffle_key
FROM (SELECT doc_id, source, n_chars, unnest(range(n)) AS copy FROM drawn)
"""

_OP3 = r"""
WITH RECURSIVE m AS (
  SELECT conv_id, turn, text, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS norm,
    lag(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) OVER (PARTITION BY conv_id ORDER BY turn) AS quoted,
    least(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1, 2) AS quote_levels
  FROM conversations),
first AS (SELECT conv_id, norm, min(turn) AS parent FROM m GROUP BY 1, 2),
p AS (
  SELECT m.*, f.parent AS parent_id FROM m
  LEFT JOIN first f ON f.conv_id = m.conv_id AND f.norm = m.quoted AND f.parent < m.turn),
tree AS (
  SELECT conv_id, turn, turn AS root_id, 0 AS depth FROM p WHERE parent_id IS NULL
  UNION ALL
  SELECT p.conv_id, p.turn, t.root_id, t.depth + 1 FROM p JOIN tree t ON t.conv_id = p.conv_id AND t.turn = p.parent_id)
SELECT p.conv_id, p.turn AS message_id, p.parent_id, t.root_id, t.depth,
  row_number() OVER (PARTITION BY p.conv_id, t.root_id ORDER BY t.depth, p.turn) - 1 AS position, p.quote_levels,
  md5(trim(p.text, E' \n\r\t')) AS own_md5
FROM p JOIN tree t USING (conv_id, turn)
"""

_OP4 = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, i AS line_no, trim(regexp_replace(parts[i + 1], '\s+', ' ', 'g')) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE text <> '')),
d AS (SELECT line, min((doc_id, line_no)) AS first FROM l WHERE line <> '' GROUP BY line),
e AS (
  SELECT a.line AS x, b.line AS y FROM d a JOIN d b ON len(b.line) BETWEEN len(a.line) AND len(a.line) + 1 AND a.line <> b.line
  WHERE len(a.line) >= 16 AND (substr(a.line, 1, len(a.line) // 2) = substr(b.line, 1, len(a.line) // 2)
    OR right(a.line, len(a.line) - len(a.line) // 2) = right(b.line, len(a.line) - len(a.line) // 2))
    AND levenshtein(a.line, b.line) <= 1),
links AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
r AS (SELECT x AS root, x AS node FROM links UNION SELECT r.root, links.y FROM r JOIN links ON links.x = r.node),
c AS (SELECT root AS line, min(d.first) AS first FROM r JOIN d ON d.line = r.node GROUP BY root),
gone AS (
  SELECT l.doc_id, list_sort(list(DISTINCT l.line_no::INTEGER)) AS dropped FROM l JOIN d USING (line) LEFT JOIN c ON c.line = l.line
  WHERE (l.doc_id, l.line_no) <> coalesce(c.first, d.first) GROUP BY l.doc_id)
SELECT t.doc_id, CASE WHEN t.text <> '' THEN len(string_split(t.text, chr(10))) ELSE 0 END AS n_lines,
  coalesce(len(g.dropped), 0) AS n_dropped, coalesce(g.dropped, []) AS dropped
FROM documents t LEFT JOIN gone g USING (doc_id)
"""

_OP9 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM benchmark),
b AS (SELECT item_id, ws, len(ws) AS n, least(5, len(ws)) AS w, len(ws) - least(5, len(ws)) + 1 AS m FROM bw WHERE len(ws) > 0),
bs AS (SELECT item_id, w, array_to_string(ws[i + 1:i + w], ' ') AS g, count(*) AS c
  FROM (SELECT item_id, ws, w, unnest(range(m)) AS i FROM b) GROUP BY 1, 2, 3),
d AS (SELECT doc_id, ws, w, len(ws) AS dn FROM dw, (SELECT DISTINCT w FROM b) WHERE len(ws) >= w),
ds AS (SELECT doc_id, w, i, array_to_string(ws[i + 1:i + w], ' ') AS g
  FROM (SELECT doc_id, ws, w, unnest(range(dn - w + 1)) AS i FROM d)),
hits AS (SELECT ds.doc_id, ds.i, ds.g, bs.item_id, bs.c FROM ds JOIN bs USING (w, g)),
starts AS (
  SELECT DISTINCT h.doc_id, h.item_id, unnest(range(greatest(0, h.i - m + 1), least(h.i, d.dn - least(b.n, d.dn)) + 1)) AS s
  FROM hits h JOIN b USING (item_id) JOIN d ON d.doc_id = h.doc_id AND d.w = b.w),
sizes AS (
  SELECT starts.*, least(b.n, d.dn) AS n_words, least(b.n, d.dn) - b.w + 1 AS span, b.m
  FROM starts JOIN b USING (item_id) JOIN d ON d.doc_id = starts.doc_id AND d.w = b.w),
counts AS (
  SELECT z.doc_id, z.item_id, z.s, z.n_words, z.span, z.m, h.g, least(count(*), any_value(h.c)) AS c
  FROM sizes z JOIN hits h ON h.doc_id = z.doc_id AND h.item_id = z.item_id AND h.i BETWEEN z.s AND z.s + z.span - 1
  GROUP BY ALL),
sums AS (
  SELECT doc_id, item_id, s AS start_word, n_words, sum(c)::BIGINT AS common, (span + m - sum(c))::BIGINT AS total
  FROM counts GROUP BY doc_id, item_id, s, n_words, span, m)
SELECT doc_id, item_id, start_word, n_words, common, total FROM sums WHERE 100 * common >= 80 * total
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY common DESC, start_word) = 1
"""


_OP12 = r"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
f AS (
  SELECT lang, p, count(*) AS c FROM (
    SELECT lang, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: ws[i:i + m - 1])) AS p FROM pieces, range(1, 4) r(m))
  GROUP BY lang, p HAVING count(*) >= 10),
sizes AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
cand AS (SELECT lang, p, c AS a FROM f WHERE len(p) >= 2),
inner_ AS (
  SELECT lang, q, max(a) AS longer FROM (
    SELECT lang, a, unnest([p[1:2], p[2:3]]) AS q FROM cand WHERE len(p) = 3) GROUP BY lang, q),
kept AS (
  SELECT cand.* FROM cand LEFT JOIN inner_ i ON i.lang = cand.lang AND i.q = cand.p WHERE coalesce(100 * i.longer < 50 * cand.a, true)),
cuts AS (
  SELECT k.lang, k.p, k.a, x.k, lf.c AS l, rt.c AS r, ((1000000::HUGEINT * k.a * k.a) // (lf.c::HUGEINT * rt.c))::BIGINT AS score
  FROM kept k, range(1, 3) x(k), f lf, f rt
  WHERE x.k < len(k.p) AND lf.lang = k.lang AND lf.p = k.p[1:x.k] AND rt.lang = k.lang AND rt.p = k.p[x.k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM best JOIN sizes USING (lang))
WHERE rank <= 2000
"""

_OP13 = (
    _OP1.replace("len(ws) < 4", "len(ws) < 3").replace("range(1, len(ws) - 2)", "range(1, len(ws) - 1)").replace("ws[i:i + 3]", "ws[i:i + 2]")
    .replace(">= 80 *", ">= 90 *").replace("""min(r.node) AS component_id,
  r.root = min(r.node) AS kept""", "min(r.node) AS component_id")
)

_OP11 = """
WITH RECURSIVE steps AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
    b::BIGINT) ORDER BY b) AS t FROM range(256) r(b)),
ids AS (
  SELECT doc_id, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: ('0x' || h[i:i + 1])::BIGINT),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 7 = 0 AS touched
  FROM (SELECT DISTINCT doc_id, hex(encode(doc_id::VARCHAR)) AS h FROM documents), steps),
d AS (SELECT d.*, n_chars + CASE WHEN touched THEN 1 ELSE 0 END AS more FROM documents d LEFT JOIN ids USING (doc_id)),
parts AS (
  SELECT doc_id, lang, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
    coalesce(length(n_chars::VARCHAR) || ':' || n_chars, '-') AS was, coalesce(length(more::VARCHAR) || ':' || more, '-') AS now,
    coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail FROM d),
leaves AS (
  SELECT doc_id, lang, leaf, checked, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, lang, sha256(head || was || tail) AS leaf, sha256(head || now || tail) AS checked FROM parts)),
up AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS hs FROM leaves GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, len(hs), 2), lambda i: sha256(array_to_string(hs[i + 1:i + 2], ''))) FROM up WHERE len(hs) > 1),
subroots AS (
  SELECT lang, hs[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM up WHERE len(hs) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY pos) AS hs FROM subroots HAVING count(*) > 0
  UNION ALL
  SELECT level + 1, list_transform(range(0, len(hs), 2), lambda i: sha256(array_to_string(hs[i + 1:i + 2], ''))) FROM top WHERE len(hs) > 1),
chains AS (SELECT lang, list(hs ORDER BY level) AS trees FROM (SELECT * FROM up WHERE len(hs) > 1) GROUP BY lang),
crown AS (SELECT coalesce(list(hs ORDER BY level), []) AS trees FROM top WHERE len(hs) > 1),
heads AS (SELECT lang, subroot, list_transform(range(len(trees)), lambda k: [CASE WHEN (pos >> k) & 1 = 1 THEN 'l' ELSE 'r' END,
  coalesce(trees[k + 1][xor(pos >> k, 1) + 1], '')]) AS proof FROM subroots, crown),
proofs AS (
  SELECT l.*, h.subroot, list_concat(list_transform(range(coalesce(len(c.trees), 0)), lambda k: [CASE WHEN (l.pos >> k) & 1 = 1 THEN 'l' ELSE 'r' END,
    coalesce(c.trees[k + 1][xor(l.pos >> k, 1) + 1], '')]), h.proof) AS proof
  FROM leaves l JOIN heads h ON h.lang IS NOT DISTINCT FROM l.lang LEFT JOIN chains c ON c.lang IS NOT DISTINCT FROM l.lang),
folded AS (
  SELECT *, list_reduce(list_concat([['', checked]], proof), lambda a, s:
    ['', sha256(CASE WHEN s[1] = 'l' THEN s[2] || a[2] ELSE a[2] || s[2] END)])[2] AS folded_root,
    sha256(array_to_string(list_transform(proof, lambda s: s[2]), '')) AS proof_sha256
  FROM proofs)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM folded, (SELECT hs[1] AS root FROM top WHERE len(hs) = 1)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_minhash_near_dedup": _OP1, "op3_quotation_linking": _OP3, "op4_segment_line_dedup": _OP4, "op7_hash_tree_shards": _OP7, "op9_simhash_decontamination": _OP9, "op10_poisson_mixture": _OP10,
        "op11_merkle_manifest": _OP11,
        "op12_phrase_collocations": _OP12,
        "op13_ngram_jaccard_join": _OP13,
    }
