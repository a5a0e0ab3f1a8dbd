"""Language identification by compression with one dictionary for each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.functions.expressions import quoted
from lateline.llm.spans import slices, texts

UNKNOWN = "und"
#: Each dictionary is made of at most so many pieces of so many characters.
PIECES, PIECE_CHARS = 128, 1_000
#: Texts are compressed in blocks of so many bytes, each against the dictionary alone.
BLOCK = 4_096
_LEVEL = 9
#: Bits saved count this much in the score; compressed sizes of neighbouring words depend on each other.
_TRUST = 0.05


def held_out(identifier: Column) -> Column:
    """One row in five, by the checksum of its identifier; a null identifier is not held out."""
    return F.coalesce(F.crc32(identifier.cast("string")) % 5 == 0, F.lit(False))


@dataclass
class LanguageModel:
    """A raw-content dictionary for each language, the commoner language first."""

    languages: list[str]
    dictionaries: list[bytes]


def learn(labelled: DataFrame, text_column: str = "text", lang_column: str = "lang") -> LanguageModel:
    """Collect a dictionary for each language from rows with a text and a language.

    A dictionary is a bounded sample: one piece of up to ``PIECE_CHARS`` characters from each of
    ``PIECES`` different texts, taken by hash over all of them, so that it does not depend on
    the order of rows or on copies. One row for each language and piece reaches the driver.
    """
    rows = labelled.select(F.col(lang_column).alias("lang"), F.lower(F.col(text_column)).alias("text")).filter(
        F.col("lang").isNotNull() & (F.length("text") > 0)).withColumn("hash", F.xxhash64("text"))
    known = rows.groupBy("lang").agg(
        F.approx_count_distinct("hash").alias("texts"), F.count(F.lit(1)).alias("rows")).collect()
    if not known:
        return LanguageModel([], [])
    known.sort(key=lambda r: (-r["rows"], r["lang"]))
    rate = F.create_map(*[x for r in known for x in (F.lit(r["lang"]), F.lit(min(1.0, 2 * PIECES / max(r["texts"], 1))))])
    share = (F.col("hash") / F.lit(float(1 << 63)) + 1) / 2
    room = F.greatest(F.length("text") - PIECE_CHARS, F.lit(0)) + 1
    picked = rows.filter(share <= rate[F.col("lang")]).select(
        "lang", "hash", F.substring("text", (F.pmod("hash", room) + 1).cast("int"), F.lit(PIECE_CHARS)).alias("piece"))
    pieces = picked.groupBy("lang", "hash").agg(F.min("piece").alias("piece")).collect()
    chosen: dict[str, list[str]] = {r["lang"]: [] for r in known}
    for r in sorted(pieces, key=lambda r: r["hash"]):
        if len(chosen[r["lang"]]) < PIECES:
            chosen[r["lang"]].append(r["piece"])
    return LanguageModel(list(chosen), ["\n".join(x).encode() for x in chosen.values()])


def identify(docs: DataFrame, model: LanguageModel, text_column: str = "text", min_margin: float = 0.005) -> DataFrame:
    """Add ``lang_pred``, ``score``, ``margin`` and ``accepted`` to every row.

    Each whole text, in lower case, is compressed with every dictionary, in blocks that start from the
    dictionary alone so that the margin does not fade with the length, and the smallest sum
    wins; ties go to the commoner language. ``margin`` is how much larger the second sum
    is, as a share of the smallest. ``score`` (0 to 1) weighs the bytes saved against all other
    languages. A row is ``accepted`` if its margin is at least ``min_margin``.

    A null text or one without a letter is ``und`` with score 0 and is not accepted; so is
    everything if the model knows no language. With one language the margin is 1.
    Columns of the input with one of the four names are replaced, all others are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.dictionaries))
    added = ["lang_pred", "score", "margin", "accepted"]
    kept = [c for c in docs.columns if c not in added]
    plain = [f"c{k}" for k in range(len(kept))]  # functions over batches can't take every name
    # The text goes to Python once: as a kept column if it is one.
    own = plain[kept.index(text_column)] if text_column in kept else "__text"
    inner = docs.select(*[quoted(c).alias(n) for c, n in zip(kept, plain)],
                        *([] if own in plain else [quoted(text_column).alias(own)]),
                        F.coalesce(quoted(text_column).rlike(r"\p{L}"), F.lit(False)).alias("__letters"))
    schema = docs.select(*map(quoted, kept)).toDF(*plain).schema.add("lang_pred", "string").add("score", "double").add(
        "margin", "double").add("accepted", "boolean")

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, dictionaries = shared.value
        squeeze = [_compressor(d).compress for d in dictionaries]
        for batch in batches:
            for part in slices(batch, own):
                t = texts(_lower(part.column(own)))
                sizes = np.zeros((len(t), max(len(languages), 1)))
                letters = part.column("__letters").to_numpy(zero_copy_only=False).astype(bool)
                raw = t.data.tobytes()
                if languages:
                    for i in np.flatnonzero(letters):
                        blocks = [raw[a:min(a + BLOCK, t.edges[i + 1])] for a in range(t.edges[i], t.edges[i + 1], BLOCK)]
                        sizes[i] = [sum(len(f(b)) for b in blocks) for f in squeeze]
                best = sizes.argmin(axis=1)
                least = sizes.min(axis=1)
                others = np.partition(sizes, 1, axis=1)[:, 1] if len(languages) > 1 else 2 * least
                known = letters & bool(languages)
                margin = np.where(known, (others - least) / np.maximum(least, 1), 0.0)
                score = 1 / np.exp((least[:, None] - sizes) * 8 * np.log(2) * _TRUST).sum(axis=1)
                columns = [part.column(c) for c in plain]
                columns += [pa.array([languages[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                            pa.array(np.where(known, score, 0.0)), pa.array(margin),
                            pa.array(known & (margin >= min_margin))]
                yield pa.RecordBatch.from_arrays(columns, [*plain, *added])

    return inner.mapInArrow(label, schema).toDF(*kept, *added)


def _lower(column: pa.Array) -> pa.Array:
    try:
        return pc.utf8_lower(column)
    except pa.ArrowInvalid:  # some text isn't valid UTF-8
        return pa.array([None if x is None else x.decode("utf-8", "replace").lower() for x in column.cast(pa.binary()).to_pylist()],
                        pa.string())


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    content = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    content.precompute_compress(level=_LEVEL)
    return zstandard.ZstdCompressor(level=_LEVEL, dict_data=content, write_content_size=False)
