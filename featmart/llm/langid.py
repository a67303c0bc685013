"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a raw-content dictionary of excerpts from labelled texts. A whole text, in lower case, is compressed piece by piece
with each dictionary, and the language of the smallest sum is the answer; ties go to the first in code-point order. The score is the margin:
how much smaller, from 0 to 1, the best is than the next (1 when only one language is known). Margins under `min_margin` are
rejected. A text that is null, empty or without a letter, or any text when no language could be learned, is `und` with score 0 and
rejected. An empty table gives no rows; repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import text_of

UNKNOWN = "und"
PIECE = 4096
LEVEL = 3
MIN_MARGIN = 0.005
ANSWER = "lang_pred string, score double, rejected boolean"


def fold(id_col: str, folds: int) -> Column:
    """CRC-32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds


def learn_dictionaries(
    training: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", docs_per_lang: int = 400, dictionary_chars: int = 240_000, max_langs: int = 200
) -> dict[str, bytes]:
    """A dictionary per language from a bounded sample: `dictionary_chars` in all, evenly out of up to `docs_per_lang` texts.

    Texts are taken in the order of a hash of id and text. A count per language tells which hashes are low enough, so that no more than
    a few times the sample is ranked. Languages are labels, of which there may be `max_langs` (more raise an error).
    """
    labelled = training.where(F.col(lang).isNotNull())
    counts = {r[0]: r[1] for r in labelled.groupBy(lang).agg(F.count(F.lit(1))).limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, min(1.0, 6 * docs_per_lang / n))])
    excerpts = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, dictionary_chars // min(n, docs_per_lang))])
    excerpt = F.element_at(excerpts, F.col(lang))
    rank = F.xxhash64(F.col(id_col).cast("string"), F.lit(3))
    low = labelled.where(F.pmod(rank, F.lit(1 << 20)) < F.element_at(share, F.col(lang)) * (1 << 20))
    order = F.xxhash64(F.col(id_col).cast("string"), text_of(text))
    start = F.pmod(order, F.greatest(F.lit(1), F.length(text) - excerpt + 1)).cast("int") + 1
    rows = low.select(F.col(lang).alias("lang"), order.alias("order"), F.substring(F.col(text), start, excerpt).alias("text")).where("length(text) > 0")
    first = Window.partitionBy("lang").orderBy("order", "text")
    taken = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= docs_per_lang).collect()
    out: dict[str, list[str]] = {}
    for row in sorted(taken, key=lambda r: (r["lang"], -r["rank"])):
        out.setdefault(row["lang"], []).append(row["text"])
    return {name: "\n".join(texts).lower().encode() for name, texts in out.items()}


class Classifier:
    """Compressors with one dictionary each."""

    def __init__(self, dictionaries: Mapping[str, bytes], min_margin: float) -> None:
        import zstandard as zstd

        self.min_margin = min_margin
        self.names = sorted(dictionaries, key=lambda n: [ord(c) for c in n])
        self.compressors = []
        # One set of parameters for all, else the library picks them by each dictionary's size and sizes can't be compared.
        largest = max(map(len, dictionaries.values()), default=0)
        settings = zstd.ZstdCompressionParameters.from_level(LEVEL, source_size=PIECE, dict_size=largest, write_content_size=0, write_checksum=0)
        for name in self.names:
            content = zstd.ZstdCompressionDict(dictionaries[name], dict_type=zstd.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            self.compressors.append(zstd.ZstdCompressor(compression_params=settings, dict_data=content))

    def __call__(self, text: str | None) -> tuple[str, float, bool]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        data = text.lower().encode()
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        sizes = [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        if len(sizes) == 1:
            return self.names[0], 1.0, False
        following = min(sizes[:best] + sizes[best + 1 :])
        margin = (following - sizes[best]) / following
        return self.names[best], margin, margin < self.min_margin


def language(text: str, dictionaries: Mapping[str, bytes], min_margin: float = MIN_MARGIN) -> Column:
    """A struct (lang_pred, score, rejected) of the text column."""

    @F.pandas_udf(ANSWER)
    def classify(texts: pd.Series) -> pd.DataFrame:
        classifier = Classifier(dictionaries, min_margin)
        return pd.DataFrame([classifier(t) for t in texts], columns=["lang_pred", "score", "rejected"])

    return classify(F.col(text))


def identify(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held: int = 1, **options) -> DataFrame:
    """One row per document: id, held_out, lang_pred, score, rejected; learned from the labelled documents that are not held out."""
    held_out = fold(id_col, folds) == held
    dictionaries = learn_dictionaries(docs.where(~held_out), id_col, text, lang, **options)
    rows = docs.select(F.col(id_col).alias(id_col), held_out.alias("held_out"), language(text, dictionaries).alias("_fl_answer"))
    return rows.select(id_col, "held_out", "_fl_answer.*")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 3, held: int = 1, **options) -> DataFrame:
    """`docs` with all its columns, without the documents whose language is rejected."""
    dictionaries = learn_dictionaries(docs.where(fold(id_col, folds) != held), id_col, text, lang, **options)
    return docs.withColumn("_fl_answer", language(text, dictionaries)).where("not _fl_answer.rejected").drop("_fl_answer")
