"""Token counts, ids, headers, pool texts and other scalar rules."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable
from functools import lru_cache
from hashlib import sha1, sha256
from itertools import zip_longest

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column
from pyspark.sql import functions as F

from quillspark.functions.slices import sliced

#: Letters that count as a token each (Hangul syllables, kana, CJK ideographs).
CJK = "[가-힣぀-ヿ一-鿿]"
#: White space that separates words: Unicode's and the four separator controls.
SPACES = "(?U)[\\s\\x1c-\\x1f]+"
#: Fixed value: a cell that counts as a number.
NUMBER_CELL = r"^-?\d+(?:\.\d+)?$"
#: Fixed value: the ISO OID name space of RFC 4122.
OID_NAMESPACE = "6ba7b8129dad11d180b400c04fd430c8"
#: Document types, and the label that stands for each, in order of precedence.
DOC_TYPE_LABELS = (
    ("장애대응", "incident"),
    ("troubleshooting", "troubleshoot"),
    ("faq", "faq"),
    ("회의록", "meeting"),
    ("adr", "adr"),
)
DOC_TYPES = ("operation", "incident", "troubleshoot", "adr", "faq", "meeting")
DEFAULT_DOC_TYPE = "operation"


def computed_once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once a row however often its use names it, also within lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def count_tokens(text: Column) -> Column:
    """Each CJK letter is a token; what they leave is counted in words."""
    letters = F.length(text) - F.length(F.regexp_replace(text, CJK, ""))
    words = F.filter(F.split(F.regexp_replace(text, CJK, " "), SPACES), lambda w: w != "")
    return F.coalesce(letters + F.size(words), F.lit(0))


def chunk_id(page_id: Column, index: Column, attachment_id: Column | None = None) -> Column:
    """SHA-1 of page, index and attachment (empty for a page's own chunk)."""
    attachment = F.lit("") if attachment_id is None else F.coalesce(attachment_id, F.lit(""))
    return F.sha1(F.concat_ws(":", page_id, index.cast("string"), attachment).cast("binary"))


def point_id(chunk: Column) -> Column:
    """UUID version 5 of a chunk id in the OID name space."""
    digest = F.sha1(F.concat(F.unhex(F.lit(OID_NAMESPACE)), chunk.cast("binary")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"), F.substring(digest, 14, 3), F.lit("-"),
        F.lower(F.hex(variant)), F.substring(digest, 18, 3), F.lit("-"), F.substring(digest, 21, 12),
    )


def section_header(header: Column) -> Column:
    trimmed = F.trim(F.coalesce(header, F.lit("")))
    return F.when(trimmed == "", F.lit("untitled")).otherwise(trimmed)


def section_path(ancestors: Column, header: Column, filename: Column | None = None) -> Column:
    """Ancestors, the file name of an attachment, and the header, joined by " > "."""
    return F.concat_ws(" > ", ancestors, *([] if filename is None else [filename]), section_header(header))


def pool_texts(title: Column, filename: Column, header: Column, text: Column, labels: Column, space: Column, kind: Column) -> Column:
    """What each pool embeds: title, content and label, as an array of (pool, text)."""
    name = F.when(F.coalesce(filename, F.lit("")) != "", filename).otherwise(title)
    return F.array(
        F.struct(F.lit("title").alias("pool"), F.trim(F.concat_ws(" ", name, header)).alias("text")),
        F.struct(F.lit("content").alias("pool"), text.alias("text")),
        F.struct(F.lit("label").alias("pool"), F.trim(F.concat_ws(" ", F.array_join(labels, " "), space, kind)).alias("text")),
    )


#: Code points that ``SPACES`` matches.
_SPACE_POINTS = np.array([*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def top_share(text: str | None) -> float:
    """Share of the most frequent code point among those that are not white space; 0 without any."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return 0.0
    if int(points.max()) < 1 << 16:
        counts = np.bincount(points, minlength=int(_SPACE_POINTS.max()) + 1)
        counts[_SPACE_POINTS] = 0
    else:
        counts = np.unique(points[~np.isin(points, _SPACE_POINTS)], return_counts=True)[1]
    total = int(counts.sum())
    return float(counts.max()) / total if total else 0.0


def max_char_ratio(text: Column) -> Column:
    """``top_share`` over a column, counted in Arrow batches."""
    return sliced(lambda texts: pa.array([top_share(x.as_py()) for x in texts], pa.float64()), "double", text)


def normalize_link(link: Column, site: str) -> Column:
    """Absolute links stay; others get the site, and the wiki path where it is missing; blanks stay as they are."""
    bare, path = site.strip().rstrip("/"), F.trim(F.coalesce(link, F.lit("")))
    if not bare:
        return link
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))
    base = F.when(rooted.startswith("/wiki/"), F.lit(bare)).otherwise(F.lit(f"{bare}/wiki"))
    return F.when(path == "", link).when(path.rlike("^https?://"), path).otherwise(F.concat(base, rooted))


def parse_iso_offset(value: Column) -> Column:
    """Timestamps whose offset may lack its colon; null where it is no timestamp."""
    return F.try_to_timestamp(F.regexp_replace(value, r"([+-]\d{2})(\d{2})$", "$1:$2"))


def to_kst(value: Column) -> Column:
    """A UTC timestamp as ISO text at +09:00."""
    local = F.from_utc_timestamp(value, "Asia/Seoul")
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+09:00"))


def infer_doc_type(labels: Column) -> Column:
    """First document type whose label is present, ignoring case; operation without one."""
    lower = F.transform(labels, F.lower)
    out = F.lit(DEFAULT_DOC_TYPE)
    for label, kind in reversed(DOC_TYPE_LABELS):
        out = F.when(F.array_contains(lower, label), F.lit(kind)).otherwise(out)
    return out


def coerce_doc_type(kind: Column) -> Column:
    return F.when(kind.isin(*DOC_TYPES), kind).otherwise(F.lit(DEFAULT_DOC_TYPE))


def normalize_ids(ids: Column) -> Column:
    """Trimmed, without blanks and repeats, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(ids, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))))


def _said(number: float | None) -> str:
    """A number with seven digits; what is none in the words that Spark has for it."""
    text = "null" if number is None else f"{number:.6e}"
    return text if text[-1] not in "nf" else text.replace("nan", "NaN").replace("inf", "Infinity")


@lru_cache(1 << 12)
def _said_count(number: float | None) -> str:
    """Counts come again and again, other numbers do not."""
    return _said(number)


def _digest(parts: Iterable[str]) -> str:
    return sha1(",".join(parts).encode()).hexdigest()


def hash_dense(vector: Column) -> Column:
    """SHA-1 of a vector's numbers with seven digits each."""

    def each(vectors: pa.Array) -> pa.Array:
        return pa.array([None if x is None else _digest(map(_said, x)) for x in vectors.to_pylist()], pa.string())

    return sliced(each, "string", vector.cast("array<double>"))


def hash_sparse(indices: Column, values: Column) -> Column:
    """SHA-1 of "index:number" of a sparse vector."""

    def each(places: pa.Array, numbers: pa.Array) -> pa.Array:
        def one(at: list | None, said: list | None) -> str | None:
            if at is None or said is None:
                return None
            return _digest(f"{'null' if i is None else i}:{_said_count(x)}" for i, x in zip_longest(at, said))

        return pa.array(list(map(one, places.to_pylist(), numbers.to_pylist())), pa.string())

    return sliced(each, "string", indices.cast("array<bigint>"), values.cast("array<double>"))


def _unit_vectors(digests: pa.Array, size: int) -> pa.Array:
    """Bytes of hexadecimal digests, repeated, scaled to [-1, 1] and to length 1; nulls where there is no digest."""
    raw = np.frombuffer(bytes.fromhex("".join(x or "00" * 32 for x in digests.to_pylist())), np.uint8).reshape(-1, 32)
    numbers = raw[:, np.arange(size) % 32] / 127.5 - 1.0
    norms = np.sqrt(np.cumsum(numbers * numbers, axis=1)[:, -1:])  # added up in order, as the sum of squares is defined
    numbers = np.divide(numbers, norms, out=numbers, where=norms > 0)
    missing = np.repeat(digests.is_null().to_numpy(zero_copy_only=False), size)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, numbers.size + 1, size), pa.int32()), pa.array(numbers.ravel(), pa.float64(), mask=missing))


def hash_embed_dense(text: Column, prefix: str, size: int) -> Column:
    """Deterministic stand-in for a model: bytes of a SHA-256, repeated, scaled to [-1, 1] and to length 1."""
    return sliced(lambda digests: _unit_vectors(digests, size), "array<double>", F.sha2(F.concat(F.lit(f"{prefix}:"), text).cast("binary"), 256))


def token_index(token: Column, vocabulary: int = 100_000) -> Column:
    """First four bytes of a token's SHA-256, modulo the size of the vocabulary."""
    return (F.conv(F.substring(F.sha2(token.cast("binary"), 256), 1, 8), 16, 10).cast("long") % vocabulary).cast("int")


#: Words whose index a worker remembers, and the longest of them.
_KNOWN_WORDS, _KNOWN_LENGTH = 1 << 17, 64


def _index_of(word: str) -> int:
    return int.from_bytes(sha256(word.encode()).digest()[:4])


@lru_cache(_KNOWN_WORDS)
def _index_of_known(word: str) -> int:
    return _index_of(word)


def _counted(texts: pa.Array, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, indices, counts): of each text its words' indices, ascending, and how often they come."""
    sizes, indices, counts = [0], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for one in texts:
        words = Counter((one.as_py() or "").split())
        at = np.fromiter((_index_of_known(w) if len(w) <= _KNOWN_LENGTH else _index_of(w) for w in words), np.int64, len(words)) % vocabulary
        found, place = np.unique(at, return_inverse=True)
        sizes.append(len(found))
        indices.append(found)
        counts.append(np.bincount(place, np.fromiter(words.values(), np.float64, len(words)), len(found)).astype(np.int64))
    return np.cumsum(sizes), np.concatenate(indices), np.concatenate(counts)


def _term_lists(ends: np.ndarray, indices: np.ndarray, counts: np.ndarray) -> pa.Array:
    items = pa.StructArray.from_arrays([pa.array(indices, pa.int32()), pa.array(counts, pa.int64())], names=["idx", "tf"])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), items)


def term_counts(text: Column, vocabulary: int = 100_000) -> Column:
    """Lower-cased words hashed into a vocabulary (``token_index``) and counted: an array of (idx, tf), ascending by index.

    A text's words are counted where it lies, so that no row per word is made.
    """
    return sliced(lambda texts: _term_lists(*_counted(texts, vocabulary)), "array<struct<idx: int, tf: bigint>>", F.lower(text))


def asked_term_counts(text: Column, asked: Broadcast, vocabulary: int = 100_000) -> Column:
    """``term_counts`` of the indices that are in a broadcast array (all, if that is None), and ``said``: whether the text has any word."""

    def each(texts: pa.Array) -> pa.Array:
        ends, indices, counts = _counted(texts, vocabulary)
        said = pa.array(np.diff(ends) > 0)
        if asked.value is not None:
            keep = np.isin(indices, asked.value)
            ends, indices, counts = np.r_[0, np.cumsum(keep)][ends], indices[keep], counts[keep]
        return pa.StructArray.from_arrays([said, _term_lists(ends, indices, counts)], names=["said", "terms"])

    return sliced(each, "struct<said: boolean, terms: array<struct<idx: int, tf: bigint>>>", F.lower(text))


def is_pdf_heading(text: Column, size: Column, bold: Column, body_size: Column) -> Column:
    """Short lines that are large, or bold and a little larger than the body."""
    short = (F.length(F.trim(text)).between(1, 80)) & (F.size(F.split(F.trim(text), SPACES)) <= 12)
    large = (size >= 1.15 * body_size) | (bold & (size >= 1.05 * body_size))
    return F.coalesce((body_size > 0) & short & large, F.lit(False))


def cell_to_string(value: Column, kind: str) -> Column:
    """A typed cell as text; ``kind`` is the name of its Spark type.

    Whole floating-point numbers have no fraction, others six significant
    digits; times are in ISO form; other values are trimmed; null is empty.
    """
    if kind in ("double", "float"):
        # Rounding to digits must see the number's exact binary value, which the built-in formats do not.
        def each(numbers: pd.Series) -> pd.Series:
            return pd.Series([f"{x + 0.0:.0f}" if x == x // 1 else f"{x:g}" for x in numbers.astype(float).tolist()])

        text = F.when(value.isNull(), "").otherwise(F.pandas_udf(each, "string")(value.cast("double")))
    elif kind.startswith("timestamp"):
        micros = F.date_format(value, "SSSSSS")
        text = F.concat(F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""))
    elif kind == "boolean":
        text = F.initcap(value.cast("string"))
    else:
        text = F.trim(value.cast("string"))
    return F.coalesce(text, F.lit(""))


def serialize_row(sheet: Column, header: Column, cells: Column) -> Column:
    """"[sheet] column: value | …" without empty cells; columns beyond the header are numbered."""
    named = F.transform(
        cells,
        lambda x, i: F.struct(
            F.trim(F.coalesce(x, F.lit(""))).alias("value"),
            F.coalesce(F.get(header, i), F.concat(F.lit("col_"), (i + 1).cast("string"))).alias("name"),
        ),
    )
    full = F.transform(F.filter(named, lambda x: x["value"] != ""), lambda x: F.concat_ws(": ", x["name"], x["value"]))
    return F.concat(F.lit("["), sheet, F.lit("] "), F.array_join(full, " | "))


def is_header_row(cells: Column) -> Column:
    """Some cell is filled, and no filled cell is a number."""
    full = F.filter(F.transform(cells, lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != "")
    return (F.size(full) > 0) & F.forall(full, lambda x: ~x.rlike(NUMBER_CELL))


def header_names(cells: Column, width: Column) -> Column:
    """Column names of a header row, numbered where blank or missing."""
    names = F.transform(F.sequence(F.lit(1), width), lambda i: F.trim(F.coalesce(F.get(cells, i - 1), F.lit(""))))
    return F.transform(names, lambda x, i: F.when(x == "", F.concat(F.lit("col_"), (i + 1).cast("string"))).otherwise(x))


def sample_text(title: Column, labels: Column, body: Column, size: int = 2000) -> Column:
    """What a classifier sees of a page: title, labels and the start of its body."""
    return F.concat_ws("\n", title, F.array_join(labels, ", "), F.substring(body, 1, size))
