"""Language identification by language-bitmask n-gram filters (bit-sliced Bloom filters)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fmix, give_back, lots, query, table

BLOCK_BYTES = 1 << 20  # each byte costs about eight 8-byte numbers on the way
UNKNOWN = "und"
LEAST_MEMBERS = 0.05  # of a text's n-grams; the lowest share of a text of the four test languages is .35 at sf 0.1
_SALTS = [np.uint64(s) for s in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


def _lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts in lower case, offset per text)."""
    texts = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def gram_codes(data: np.ndarray, n: int) -> np.ndarray:
    """Code of the n bytes from each place; the last n - 1 places have none."""
    codes = np.zeros(max(0, len(data) - n + 1), np.uint64)
    for i in range(n):
        codes |= data[i : len(codes) + i].astype(np.uint64) << np.uint64(8 * i)
    return codes


def slots_of(codes: np.ndarray, bits: int, hashes: int) -> list[np.ndarray]:
    """Places of each n-gram in a filter of 2^bits slots."""
    mixed = fmix(codes * _SALTS[0] + _SALTS[1])
    return [((mixed * _SALTS[i] + _SALTS[i]) >> np.uint64(64 - bits)).astype(np.int64) for i in range(hashes)]


@dataclass
class Filters:
    """``masks[slot, word]`` holds one bit per language; ``wrong`` is each language's share of false positives."""

    languages: list[str]
    masks: np.ndarray
    wrong: np.ndarray
    n: int
    hashes: int

    def hits(self, codes: np.ndarray) -> list[np.ndarray]:
        """For each mask word, the languages that contain each n-gram."""
        bits = int(self.masks.shape[0]).bit_length() - 1
        places = slots_of(codes, bits, self.hashes)
        out = []
        for w in range(self.masks.shape[1]):
            column = np.ascontiguousarray(self.masks[:, w])
            found = column[places[0]]
            for p in places[1:]:
                found = found & column[p]
            out.append(found)
        return out


def build_filters(texts: list[str], languages: list[str], n: int = 4, hashes: int = 3, share: float = 0.5, least: int = 2, slots_per_gram: int = 16) -> Filters:
    """One pass over a bounded sample: an n-gram enters the filters of the languages in which its
    relative frequency reaches ``share`` of its greatest, if the sample has it ``least`` times."""
    names = sorted(set(languages))
    count: list[tuple[np.ndarray, np.ndarray]] = []
    for name in names:
        data, _ = _lowered(pa.array([t + "\n" for t, lang in zip(texts, languages, strict=True) if lang == name]))
        count.append(np.unique(gram_codes(data, n), return_counts=True))
    grams = np.unique(np.concatenate([c[0] for c in count])) if count else np.zeros(0, np.uint64)
    table = np.zeros((len(names), len(grams)))
    for i, (codes, times) in enumerate(count):
        table[i, np.searchsorted(grams, codes)] = times
    enough = table.sum(0) >= least
    rate = table / np.maximum(table.sum(1, keepdims=True), 1)
    member = (rate >= share * rate.max(0)) & (rate > 0) & enough if len(names) else table.astype(bool)
    bits = max(10, int(np.ceil(np.log2(max(1, slots_per_gram * member.any(0).sum())))))
    masks = np.zeros((1 << bits, max(1, -(-len(names) // 64))), np.uint64)
    for i in range(len(names)):
        bit = np.uint64(1) << np.uint64(i % 64)
        for places in slots_of(grams[member[i]], bits, hashes):
            masks[places, i // 64] |= bit
    fill = [float(((masks[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(names))]
    return Filters(names, masks, np.array(fill) ** hashes, n, hashes)


def popcounts(filters: Filters, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams per text, corrected count of members per text and language)."""
    total = np.maximum(np.diff(offsets) - filters.n + 1, 0)
    codes = gram_codes(data, filters.n)
    found = filters.hits(codes)
    counts = np.zeros((len(total), len(filters.languages)))
    for i in range(len(filters.languages)):
        bit = (found[i // 64] >> np.uint64(i % 64)) & np.uint64(1)
        sums = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        ends = np.minimum(offsets[:-1] + total, len(codes))
        counts[:, i] = sums[ends] - sums[np.minimum(offsets[:-1], len(codes))]
    free = total[:, None] * filters.wrong
    return total, np.maximum(counts - free, 0) / np.maximum(1 - filters.wrong, 1e-9)


def fit(docs: DataFrame, per_language: int = 1500, max_bytes: int = 65_536, **options) -> Filters:
    """Filters from a bounded sample of labelled texts.

    The bound is about ``per_language`` texts of at most ``max_bytes`` bytes for each language, those whose hashed id falls
    below the share that leaves so many; rows without id, text or language are not used.
    """
    known = docs.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") <= max_bytes))
    share = {r.lang: per_language / r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per language
    if not share:
        return build_filters([], [], **options)
    limit = F.element_at(F.create_map(*[F.lit(v) for pair in share.items() for v in pair]), F.col("lang"))
    rows = known.where(unit_of("doc_id") < limit).select("doc_id", "text", "lang").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id, r.text))
    filters = build_filters([r.text for r in rows], [r.lang for r in rows], **options)
    del rows
    give_back()
    return filters


def _judged(filters: Filters, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(predicted language, score, whether the text stays in :func:`reject`) of each text."""
    letter = regex.compile(r"\p{L}").search
    names = np.array([*filters.languages, UNKNOWN], object)
    lettered = np.array([bool(t and letter(t)) for t in texts.to_pylist()], bool)
    if not filters.languages:
        return names[np.zeros(len(lettered), int)], np.zeros(len(lettered)), lettered
    with np.errstate(over="ignore"):
        total, counts = popcounts(filters, *_lowered(texts))
    best = np.where(lettered, np.argmax(counts, 1), len(filters.languages))
    score = np.where(lettered, counts.max(1) / np.maximum(counts.sum(1), 1e-9), 0.0)
    enough = (score > 0) & (counts.max(1) >= LEAST_MEMBERS * total)
    return names[best], score, lettered & (enough | (total == 0))


def _predict(filters: Filters, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return _judged(filters, texts)[:2]


def identify(docs: DataFrame, filters: Filters, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score) per row: the language with the most members, and its share of all members.

    Every n-gram of the whole text is looked up once, and the slot masks answer for all
    languages together. ``und`` with score 0 where the text is null or has no letter, or nothing was learned. A text shorter
    than an n-gram, or without any member, takes the first language with score 0. Ties take the
    first language by name. Rows are scored apart from each other, so null or repeated keys are carried along; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for part in lots(batches, "text", BLOCK_BYTES):
            names, score = _predict(shared.value, part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score)], [key, "lang_pred", "score"])

    rows = docs.select(key, F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, lang_pred string, score double")


def reject(docs: DataFrame, filters: Filters) -> DataFrame:
    """``docs`` with its own columns, without the rows of no known language.

    A row stays where the language of the greatest score contains at least ``LEAST_MEMBERS`` of the
    text's n-grams after the correction. A text with letters that is shorter than an n-gram has nothing to judge and
    stays; so does every text with letters if no language was learned. Null and letterless texts go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches):
        for part in lots(batches, "text", BLOCK_BYTES):
            yield part.filter(pa.array(_judged(shared.value, part.column("text"))[2]))

    return docs.mapInArrow(run, docs.schema)


def unit_of(*columns: str):
    """A number in [0, 1) from the hash of some columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def held_out(modulus: int):
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")), F.lit(modulus)), F.lit(-1))


@query("op10_language_bloom")
def op10(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "text", "lang")
    filters = fit(docs.where(F.col("doc_id").isNotNull() & (held_out(4) != 2)))
    return identify(docs, filters).select("doc_id", (held_out(4) == 2).alias("held_out"), "lang_pred", "score")
