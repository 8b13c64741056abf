"""Language by compression: the smallest zstandard size under raw-content dictionaries.

Every language gets a dictionary of raw text pieces from its labelled documents. A text is cut into
pieces of ``PIECE`` characters, so that a long text cannot serve as its own dictionary; every piece
is compressed under every dictionary and the sizes are summed over the whole text. The smallest sum
wins; a margin under ``MARGIN`` of it rejects the decision (``rejected``), while ``lang_pred`` still
names the best guess.

Languages keep dictionaries of different lengths, and a longer one shrinks any text further. So sizes under
a shorter dictionary are scaled by what a text of another language gains when a dictionary is as long
as the longest instead (``gains``); with equal lengths all factors are 1.

Dictionaries are fitted on a bounded sample: at most ``PIECES`` slices of ``SLICE`` characters for
each language, one slice from each labelled document, those of the smallest hash of their id.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reqframe.llm.common import share

PIECE = 2048  # characters compressed at a time
SLICE = 1024  # characters that one document gives to a dictionary
PIECES = 256
MOST = 500  # languages
LEVEL = 6
MARGIN = 0.01
LONGEST = 4  # dictionaries that gains are measured on
PROBES = 16  # texts of each language that gains are measured with


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _coder(sample: bytes) -> zstandard.ZstdCompressor:
    options = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=PIECE, dict_size=len(sample), min_match=4, write_checksum=0, write_content_size=0, write_dict_id=0
    )
    held = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=options)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=options)


def gains(samples: dict[str, bytes], probes: dict[str, list[bytes]]) -> dict[str, float]:
    """For each language, how much smaller texts get by a longest dictionary of another language
    than by that dictionary cut to the length of this language's."""
    order = sorted(samples, key=lambda x: (-len(samples[x]), x))
    longest = order[:LONGEST]
    full = {lang: _coder(samples[lang]) for lang in longest}
    out: dict[str, float] = {}
    for lang in order:
        ratios = []
        for other in longest:
            if len(samples[other]) <= len(samples[lang]):
                continue
            short = _coder(samples[other][-len(samples[lang]) :])
            foreign = [x for k in longest if k != other for x in probes[k]] or [x for k in order if k != other for x in probes[k]]
            before, after = (sum(len(c.compress(x)) for x in foreign) for c in (short, full[other]))
            ratios.append(out[other] * after / before)
        out[lang] = float(np.mean(ratios)) if ratios else 1.0
    return out


class Languages:
    """Raw-content dictionaries by language."""

    def __init__(self, samples: dict[str, bytes], factors: dict[str, float] | None = None):
        self.samples = dict(sorted(samples.items()))
        self.factors = factors or {}
        self.coders: dict[str, zstandard.ZstdCompressor] = {}

    def __getstate__(self):
        return {"samples": self.samples, "factors": self.factors, "coders": {}}

    def _ready(self) -> None:
        if self.coders or not self.samples:
            return
        for lang, sample in self.samples.items():
            self.coders[lang] = _coder(sample)

    def sizes(self, text: str) -> dict[str, float]:
        """Compressed bytes of the whole text under each language's dictionary, as if all were equally long."""
        self._ready()
        text = unicodedata.normalize("NFC", text)
        pieces = [text[i : i + PIECE].encode("utf-8", "surrogatepass") for i in range(0, len(text), PIECE)]
        return {lang: sum(len(c.compress(p)) for p in pieces) * self.factors.get(lang, 1.0) for lang, c in self.coders.items()}

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score (how much smaller than the runner-up, mapped to 0..1) and rejection."""
        if not has_letter(text) or not self.samples:
            return "und", 0.0, True
        sizes = sorted((n, lang) for lang, n in self.sizes(text).items())
        if len(sizes) == 1:
            return sizes[0][1], 1.0, False
        margin = (sizes[1][0] - sizes[0][0]) / max(sizes[1][0], 1)
        return sizes[0][1], float(margin / (margin + MARGIN)), margin < MARGIN


def train(documents: DataFrame, pieces: int = PIECES) -> Languages:
    """Dictionaries from labelled rows outside the held-out fold (``crc32(doc_id) mod 4 = 2``).

    Each language's ids of the smallest hashes give a slice each; ids alone are counted and chosen, and texts are read for the
    chosen ones. Copies of an id count once, by the least slice. More than ``MOST`` languages are an error.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    usable = docs.where("doc_id is not null and lang is not null and text is not null").where(share("doc_id", 4) != 2)
    # an id is one row whatever its copies; the smallest of hashes that are spread evenly are under a bound known from their number
    ids = usable.select("lang", "doc_id").distinct()
    counts = {r[0]: r[1] for r in ids.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MOST + 1).collect()}
    if len(counts) > MOST:
        raise ValueError(f"more than {MOST} languages are labelled")
    if not counts:
        return Languages({})
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, (4 * pieces + 256) / n))])
    placed = ids.withColumn("h", F.xxhash64("doc_id"))
    few = placed.where(F.pmod("h", F.lit(1 << 40)) / float(1 << 40) <= F.element_at(bound, F.col("lang")))
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(1 << 40)), "doc_id")  # a few times ``pieces`` rows
    chosen = few.withColumn("n", F.row_number().over(order)).where(f"n <= {pieces}")
    # MOST * pieces ids at most
    at = F.when(F.length("text") > SLICE, F.pmod("h", F.length("text") - SLICE)).otherwise(F.lit(0)).cast("int") + 1
    rows = usable.join(F.broadcast(chosen.drop("n")), ["doc_id", "lang"]).select("lang", "doc_id", "h", F.substring(F.col("text"), at, F.lit(SLICE)).alias("piece"))
    rows = rows.groupBy("lang", "doc_id", "h").agg(F.min("piece").alias("piece"))
    table = rows.orderBy("lang", "h", "piece").toArrow()
    samples: dict[str, list[bytes]] = {}
    for lang, piece in zip(table.column("lang").to_pylist(), table.column("piece").to_pylist(), strict=True):
        if has_letter(piece):
            samples.setdefault(lang, []).append(unicodedata.normalize("NFC", piece).encode("utf-8", "surrogatepass"))
    whole = {lang: b"\n".join(x) for lang, x in samples.items()}
    return Languages(whole, gains(whole, {lang: x[:PROBES] for lang, x in samples.items()}))


def languages(documents: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``, a row per row of ``documents``.

    Texts that are null or without a letter get ``und``, a score of 0 and are rejected, and so does
    everything if no language could be learned. A null doc_id is carried through with a null
    ``held_out``; repeated rows are predicted each; other columns are ignored. Ties go to the
    language first in order. An empty table gives no rows.
    """
    model = train(documents)

    def run(batches):
        for batch in batches:
            got = [model.predict(x) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([x[0] for x in got], pa.string()), pa.array(np.array([x[1] for x in got], float)), pa.array([x[2] for x in got], pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return out.select("doc_id", (share("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
