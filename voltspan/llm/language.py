"""Language identification by compression with per-language zstandard dictionaries.

Training takes a bounded sample of labelled texts per language and joins it to a raw-content
dictionary. A text is encoded, piece by piece and as a whole, with every dictionary; the language
whose encoding is smallest wins, and the prediction is rejected where the runner-up is too close.

The sample: at most ``TEXTS`` distinct texts per language, those with the smallest hashes, and of
each at most ``PIECE`` characters from its middle. Everything else covers whole texts.

Defined results: null texts and texts without a letter are ``und`` with score 0 and rejected; so is
everything where nothing could be learned. Ties go to the language with most texts and are rejected.
Null labels are never learned from; repeated rows count once in training and are predicted alike.

Scale: two aggregations find the sample (one row per language and distinct sampled text reaches the
driver); prediction is a scan without a shuffle. More than ``LANGUAGES`` languages share the room of so
many: each gets fewer texts, then shorter pieces, so the dictionaries stay as large in all.
"""

from __future__ import annotations

import re

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from voltspan.llm.common import append_columns

TEXTS, PIECE, LANGUAGES = 96, 4096, 200
BLOCK = 3000
LEVEL = 3
MIN_MARGIN = 0.004
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case words alone: signs and digits say nothing about the language."""
    return _NOT_LETTERS.sub(" ", text).strip().lower()


def learn(labelled: DataFrame, texts: int = TEXTS, piece: int = PIECE, languages: int = LANGUAGES) -> dict[str, bytes]:
    """A dictionary of raw content per language, from the columns text and lang alone."""
    rows = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", F.xxhash64("text").alias("place"), "text"
    )
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("place").alias("n")).collect()
    if not sizes:
        return {}
    if len(sizes) > languages:
        room = languages * texts
        texts, piece = max(1, room // len(sizes)), max(1, piece * min(room, len(sizes)) // len(sizes))
    # the smallest hashes: a share of the hash range that holds twice the texts wanted
    share = F.element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, 2.0 * texts / max(1, r["n"])))]), F.col("lang"))
    low = F.col("place") < (share * 2.0**64 - 2.0**63)
    middle = F.greatest(F.lit(1), ((F.char_length("text") - piece) / 2).cast("int") + 1)
    sample = (
        rows.filter(low | (share >= 1.0))
        .groupBy("lang", "place")
        .agg(F.min(F.substr("text", middle, F.lit(piece))).alias("piece"))
        .collect()
    )
    # most frequent language first: it wins ties
    out: dict[str, list[tuple[int, str]]] = {r["lang"]: [] for r in sorted(sizes, key=lambda r: (-r["n"], r["lang"]))}
    for r in sample:
        out[r["lang"]].append((r["place"], r["piece"]))
    # what stands last in a dictionary is nearest to the text: longest pieces last
    return {
        lang: " ".join(sorted((letters(p) for _, p in sorted(got)[:texts]), key=lambda p: (len(p), p))).encode()
        for lang, got in out.items()
        if got
    }


class Classifier:
    """Compressors over the dictionaries; one per Python worker."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        self.coders: list[tuple[int, str, zstandard.ZstdCompressionDict, zstandard.ZstdCompressor | None]] = []
        for rank, (lang, raw) in enumerate(dictionaries.items()):
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            # compressors hold memory whatever their dictionaries: of many languages each is made when it is used
            self.coders.append((rank, lang, held, self.coder(held) if len(dictionaries) <= LANGUAGES else None))

    @staticmethod
    def coder(held: zstandard.ZstdCompressionDict) -> zstandard.ZstdCompressor:
        return zstandard.ZstdCompressor(dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False)

    def sizes(self, text: str) -> list[tuple[int, int, str]]:
        """(encoded bytes, rank, language); long texts are encoded in blocks, all of them."""
        plain = letters(text)
        blocks = [plain[i : i + BLOCK].encode() for i in range(0, len(plain), BLOCK)]
        out = []
        for rank, lang, held, coder in self.coders:
            coder = coder or self.coder(held)
            out.append((sum(len(coder.compress(b)) for b in blocks), rank, lang))
        return out

    def judge(self, text: str | None, min_margin: float = MIN_MARGIN) -> tuple[str, float, bool]:
        if not text or not self.coders or not any(c.isalpha() for c in text):
            return UNKNOWN, 0.0, True
        ranked = sorted(self.sizes(text))
        if len(ranked) == 1:
            return ranked[0][2], 1.0, False
        margin = 1.0 - ranked[0][0] / ranked[1][0]
        return ranked[0][2], margin, margin < min_margin


_ADDED = StructType(
    [StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("rejected", BooleanType())]
)


ADDED = _ADDED.names


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score (the margin, 0 to 1) and rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries)  # at most LANGUAGES * TEXTS * PIECE characters
    held: list[Classifier] = []

    def judge(texts):
        if not held:
            held.append(Classifier(shared.value))
        for text in texts:
            yield held[0].judge(text, min_margin)

    return append_columns(docs, ["text"], _ADDED, judge)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def predicted(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those that aren't held out."""
    learned = learn(docs.filter(~held_out(F.col("doc_id"))).select("text", "lang"))
    return identify(docs.select("doc_id", "text"), learned).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected"
    )
