"""Language of a text by compression: the language whose dictionary encodes it smallest.

For each language a raw-content dictionary is laid out from labelled texts. A text is reduced to its words
(lower case, runs of one word counted once, marks and digits dropped) and encoded in blocks, each with a
fresh compressor that knows only the dictionary, so that a long text cannot teach itself any language.
The smallest total wins; when the second is within `margin` of it the text is marked as rejected.

The dictionaries come from a bounded sample: for each language the `sample_rows` labelled texts of the
smallest id hash, each giving at most `sample_chars` of its words, together at most `dictionary_bytes`.
The number of languages is that of the labels in use.

Defined results: NULL text, or text without letters, is `und`, score 0 and rejected; equal sizes go to the
language first by code point; without any labelled text everything is `und`; repeated rows are predicted alike.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from .common import arrow_rows

WORDS = re.compile(r"[^\W\d_]+")
LEVEL = 3
BLOCK = 1000
SALTS = 32
UNKNOWN = "und"


def reduced(text: str | None) -> bytes:
    return " ".join(w for w, _ in groupby(WORDS.findall((text or "").lower()))).encode()


def dictionaries(labelled: DataFrame, sample_rows: int = 400, sample_chars: int = 1000, dictionary_bytes: int = 128 << 10) -> dict[str, bytes]:
    """Raw content for each language from (doc_id, text, lang)."""
    known = labelled.where("lang is not null and text is not null").withColumn("__h", F.xxhash64("doc_id"))
    low = known.select("lang", "__h", F.pmod("__h", F.lit(SALTS)).alias("__salt"))
    for keys in (("lang", "__salt"), ("lang",)):  # hashes only; a language of any size is spread first
        low = low.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__h"))).where(F.col("__n") <= sample_rows)
    last = low.groupBy("lang").agg(F.max("__h").alias("__last"))
    order = Window.partitionBy("lang").orderBy("__h", "doc_id", F.xxhash64("text"))
    sample = (known.join(F.broadcast(last), "lang").where("__h <= __last")  # one row for each language
              .withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample_rows))
    sample = sample.select("lang", "n", "text")

    def work(batch: pa.RecordBatch):
        yield {"lang": batch.column(0), "n": batch.column(1), "part": [reduced(t)[:sample_chars] for t in batch.column(2).to_pylist()]}

    parts = arrow_rows(sample, work, "lang string, n int, part binary").collect()  # sample_rows of sample_chars for each language
    of: dict[str, list[bytes]] = {}
    for r in sorted(parts, key=lambda r: (r["lang"], r["n"])):
        of.setdefault(r["lang"], []).append(bytes(r["part"]))
    return {lang: b" ".join(parts)[:dictionary_bytes] for lang, parts in of.items() if any(parts)}


class Classifier:
    def __init__(self, content: Mapping[str, bytes]):
        self.langs, self.by = sorted(content), []
        for lang in self.langs:
            d = zstandard.ZstdCompressionDict(content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            self.by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (how the size speaks for it, 0 to 1) and margin (of the second to the first)."""
        data = reduced(text)
        if not data or not self.langs:
            return UNKNOWN, 0.0, 0.0
        blocks = [data[at:at + BLOCK] for at in range(0, len(data), BLOCK)]
        sizes = np.array([sum(len(c.compress(b)) for b in blocks) for c in self.by], float)
        best = int(sizes.argmin())
        second = np.partition(sizes, 1)[1] if len(sizes) > 1 else np.inf
        return self.langs[best], float(1 / np.exp2((sizes[best] - sizes) / 8).sum()), float((second - sizes[best]) / sizes[best])


_CLASSIFIERS: dict[int, Classifier] = {}


def predict(docs: DataFrame, content: Mapping[str, bytes], margin: float = 0.004, prefix: str = "") -> DataFrame:
    """Every column of `docs`, with lang_pred, score, margin and rejected (named with `prefix`; a column of such a name gives way)."""
    names = [f"{prefix}{n}" for n in ("lang_pred", "score", "margin", "rejected")]
    kept = [c for c in docs.columns if c.lower() not in {n.lower() for n in names}]
    text = next(i for i, c in enumerate(kept) if c.lower() == "text")
    version = hash(tuple(sorted(content.items())))

    def run(batches):
        if version not in _CLASSIFIERS:
            _CLASSIFIERS.clear()
            _CLASSIFIERS[version] = Classifier(content)
        classifier = _CLASSIFIERS[version]
        for batch in batches:
            found = [classifier.predict(t) for t in batch.column(text).to_pylist()]
            cols = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.float64()))]
            cols.append(pa.array([lang == UNKNOWN or m < margin for lang, _, m in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays(batch.columns + cols, names=[*kept, *names])

    fields = StructType([docs.schema[c] for c in kept] + [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), DoubleType(), BooleanType()), strict=True)])
    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, fields)


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, by which rows are held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))
