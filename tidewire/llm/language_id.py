"""Language identification by compression.

For every language a dictionary of raw sample text is given to zstandard; a text belongs to
the language whose dictionary makes it smallest. Texts are lower-cased and reduced to their
different words, each once, so that what a text repeats does not count again; these are
compressed in short blocks, so that a dictionary matters as much at the end of a long text
as at its beginning. A run of blanks behind every block keeps zstandard from storing short
blocks raw, which would hide small differences. A text whose two best sizes are within
``min_margin`` of each other is rejected: the dictionaries do not tell.

Letters are what Unicode calls so; numerals such as a half or a superscript two are none.

Defined results: null, empty and letterless texts are ``und`` with score 0 and rejected;
ties go to the first language in alphabetical order; without any learned language every
text is ``und``; rows keep their place and other columns their values.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.common import appended, crc_of_id, doc_columns, free_name, map_batches, slices, strings, table

_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Settings:
    """``sample_slots`` rows for each of at most ``languages`` values of lang, the most frequent
    ones, are the bounded training sample; ``dictionary_bytes`` of a language's different words
    make a dictionary."""

    sample_slots: int = 64
    languages: int = 200
    dictionary_bytes: int = 64_000
    block_chars: int = 2_000
    min_margin: float = 0.02


# A lazy match finder for matches of four bytes and more; tables for a
# dictionary of 64 KB.
_PARAMETERS = {"strategy": zstandard.STRATEGY_LAZY, "min_match": 4, "window_log": 17, "hash_log": 15, "chain_log": 15, "search_log": 4, "target_length": 32}
_BLANKS = b" " * 128


def different_words(text: str) -> list[str]:
    """The different words of letters, in lower case, in the order they first stand in."""
    found = dict.fromkeys(_WORD.findall(text.lower()))
    if all(map(str.isalpha, found)):
        return list(found)
    # The expression takes numerals that are no digits for letters.
    parts = ("".join(c if c.isalpha() else " " for c in w).split() for w in found)
    return list(dict.fromkeys(p for own in parts for p in own))


def letters(text: str) -> str:
    return " ".join(different_words(text))


def drawn_words(text: str, limit: int) -> bytes:
    """``letters`` of a text, or as many of its words, drawn by a hash from all of them and
    left in their order, as have ``limit`` bytes."""
    words = [w.encode("utf-8", "replace") for w in different_words(text)]
    if sum(map(len, words)) + len(words) > limit:
        order = sorted(range(len(words)), key=lambda i: (zlib.crc32(words[i]), i))
        taken, room = set(), limit
        for i in order:
            room -= len(words[i]) + 1
            if room < 0:
                break
            taken.add(i)
        words = [w for i, w in enumerate(words) if i in taken]
    return b" ".join(words)


@dataclass
class Model:
    """Raw dictionaries by language; compressors are made once per Python worker."""

    dictionaries: dict[str, bytes]
    settings: Settings = field(default_factory=Settings)

    def __post_init__(self):
        self._compressors = None

    def __getstate__(self):
        return {"dictionaries": self.dictionaries, "settings": self.settings, "_compressors": None}

    def sizes(self, text: str) -> np.ndarray:
        """Compressed bytes of the text under every dictionary, languages in order."""
        if self._compressors is None:
            self._compressors = []
            for language in sorted(self.dictionaries):
                shared = zstandard.ZstdCompressionDict(self.dictionaries[language], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                shared.precompute_compress(compression_params=zstandard.ZstdCompressionParameters(**_PARAMETERS))
                self._compressors.append(
                    zstandard.ZstdCompressor(dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)
                )
        step = self.settings.block_chars
        blocks = [text[i : i + step].encode("utf-8", "replace") + _BLANKS for i in range(0, len(text), step)]
        return np.array([sum(len(c.compress(b)) for b in blocks) for c in self._compressors], np.int64)

    def classify(self, text: str) -> tuple[str, float, bool]:
        """Language, margin of the best size over the second (0 to 1), rejected."""
        plain = letters(text)
        if not plain or not self.dictionaries:
            return "und", 0.0, True
        sizes = self.sizes(plain)
        languages = sorted(self.dictionaries)
        best = int(np.argmin(sizes))
        if len(sizes) == 1:
            return languages[0], 1.0, False
        second = int(np.partition(sizes, 1)[1])
        margin = float(second - sizes[best]) / second
        return languages[best], margin, margin < self.settings.min_margin


def train(labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Dictionaries from rows with ``text`` and ``lang``; rows without either do not count.

    Per language and slot of the text's hash one text is taken, so that copies count once
    and no language's rows meet in one place. The task that holds a taken text reduces it to
    words before it moves.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("lang", "text", F.xxhash64("text").alias("hash"))
    slot = F.pmod("hash", F.lit(settings.sample_slots)).alias("slot")
    slots = rows.groupBy("lang", slot).agg(F.min("hash").alias("hash"), F.count(F.lit(1)).alias("rows"))
    often = F.sum("rows").over(Window.partitionBy("lang"))
    place = F.dense_rank().over(Window.orderBy(F.desc("often"), "lang"))
    # At most sample_slots rows for a language; there are languages, not rows, to be ranked.
    picked = slots.withColumn("often", often).withColumn("place", place).where(F.col("place") <= settings.languages).select("lang", "hash")
    chosen = rows.join(F.broadcast(picked), ["lang", "hash"])

    def reduce(batches):
        for batch in batches:
            for part in slices(batch):
                words = [drawn_words(t, settings.dictionary_bytes) for t in strings(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("hash"), pa.array(words, pa.binary())], names=["lang", "hash", "words"])

    reduced = map_batches(chosen, reduce, "lang string, hash bigint, words binary").groupBy("lang", "hash").agg(F.min("words").alias("words"))
    found: dict[str, dict[int, bytes]] = {}
    for row in reduced.collect():
        found.setdefault(row["lang"], {})[row["hash"]] = bytes(row["words"])
    dictionaries = {}
    for language, texts in found.items():
        plain = [texts[h] for h in sorted(texts) if texts[h]]
        if not plain:
            continue
        # Every sampled text gives the same share, and what is over goes round again.
        share, parts, left = max(64, settings.dictionary_bytes // len(plain)), [], plain
        while left and sum(map(len, parts)) < settings.dictionary_bytes:
            parts += [p[:share] for p in left]
            left = [p[share:] for p in left if len(p) > share]
        raw = b" ".join(parts)[: settings.dictionary_bytes]
        dictionaries[language] = raw + b" " * max(0, 8 - len(raw))
    return Model(dictionaries, settings)


def identify(docs: DataFrame, model: Model, column: str = "language_id") -> DataFrame:
    """``docs`` with a struct column of (lang_pred, score, rejected), which replaces any of
    that name."""
    spark, docs = docs.sparkSession, docs.drop(column)
    shared = spark.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])

    def run(batches):
        own = shared.value
        for batch in batches:
            for part in slices(batch):
                found = [dict(zip(("lang_pred", "score", "rejected"), own.classify(t))) for t in strings(part.column("text"))]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, kind)], names=[*part.schema.names, column])

    return map_batches(docs, run, appended(docs.schema, f"`{column}` struct<lang_pred:string,score:double,rejected:boolean>"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(crc_of_id(4) != 2)


def identified_documents(docs: DataFrame) -> DataFrame:
    """Rows whose language the dictionaries tell; the model is trained on ``docs``."""
    column = free_name(docs, "language_id")
    found = identify(docs, train(training_rows(docs)), column)
    return found.where(~F.col(f"{column}.rejected")).select(*docs.columns)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(training_rows(documents))
    return identify(doc_columns(documents), model).select(
        "doc_id",
        F.coalesce(crc_of_id(4) == 2, F.lit(False)).alias("held_out"),
        "language_id.lang_pred",
        "language_id.score",
    )
