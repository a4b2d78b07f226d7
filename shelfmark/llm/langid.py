"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import ROW, labelled_sample, nest, unnest

UNKNOWN = "und"
GRAM_SIZES = (1, 2, 3)
_BITS = 21  # of a code point
_BLANK = ord(" ")


@cache
def _letters() -> np.ndarray:
    """Code point of every letter, and a blank for all that is none."""
    codes = np.arange(0x110000, dtype=np.int64)
    letter = np.array([unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)])
    return np.where(letter, codes, _BLANK)


def gram_codes(text: str) -> np.ndarray:
    """All n-grams of the words of a text, as numbers; words are padded by one blank."""
    codes = _letters()[np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)]
    codes = codes[np.r_[True, (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)]]
    if len(codes) < 2:
        return codes[:0]
    found = [codes[codes != _BLANK]]
    for n in GRAM_SIZES[1:]:
        grams = codes[: len(codes) - n + 1].copy()
        inside = np.ones(len(grams), dtype=bool)  # a blank only at an end of the n-gram
        for k in range(1, n):
            nxt = codes[k : len(codes) - n + 1 + k]
            grams = (grams << _BITS) | nxt
            if k < n - 1:
                inside &= nxt != _BLANK
        found.append(grams[inside])
    return np.concatenate(found)


def ranked(grams: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` most frequent n-grams, ties by their number."""
    values, counts = np.unique(grams, return_counts=True)
    if len(values) > most:
        least = np.partition(counts, -most)[-most]
        near = counts >= least
        values, counts = values[near], counts[near]
    return values[np.lexsort((values, -counts))][:most]


def learn_profiles(
    df: DataFrame, text: str, lang: str, size: int, docs_per_lang: int, doc_id: str, most_langs: int
) -> dict[str, np.ndarray]:
    """The ``size`` most frequent n-grams of each language, in order of their rank.

    Learned from about ``docs_per_lang`` documents of each language, chosen by a hash of their
    id. Of more than ``most_langs`` values of ``lang`` those with most documents are learned, ties by name, so a
    column with many odd values grows neither what comes to the driver, ``size`` n-grams a
    language, nor what the workers get. Tasks send one count per n-gram.
    """
    rows = df.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{lang}`").alias("lang"),
        F.col(f"`{text}`").alias("text"),
    ).where("lang is not null and text is not null")
    top = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs)
    rows = rows.join(F.broadcast(top.select("lang")), "lang", "left_semi")
    sample = labelled_sample(rows, "lang", "doc_id", docs_per_lang).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, texts in pdf.groupby("lang")["text"]:
                grams = np.concatenate([gram_codes(t) for t in texts])
                values, counts = np.unique(grams, return_counts=True)
                yield pd.DataFrame({"lang": name, "gram": values, "n": counts})

    counted = (
        sample.mapInPandas(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.select("lang", "gram", rank.alias("rank")).where(F.col("rank") <= size)
    found = top.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("rank", "gram"))).alias("g"))
    return {r["lang"]: np.array([x["gram"] for x in r["g"]], np.int64) for r in found.collect()}


class Profiles:
    """Looks up the rank of n-grams in the profiles of all languages at once."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int):
        self.langs = sorted(profiles)
        self.size = size
        self.grams = np.unique(np.concatenate([*profiles.values(), np.zeros(0, np.int64)]))
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for k, name in enumerate(self.langs):
            at = np.searchsorted(self.grams, profiles[name])
            self.ranks[k, at] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language at the least out-of-place distance, and how near it is.

        An n-gram that a profile lacks is ``size`` places off, so the score is 1 for the
        profile itself and 0 for a text that has nothing in common with it.
        """
        top = ranked(gram_codes(text or ""), self.size)
        if not len(top) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, top)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == top, at, len(self.grams))
        places = self.ranks[:, at]
        off = np.where(places < 0, self.size, np.abs(places - np.arange(len(top))))
        distance = off.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], float(1 - distance[best] / (self.size * len(top)))


def identify(
    df: DataFrame,
    learn_from: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    carry: Sequence[str] | None = None,
    size: int = 300,
    docs_per_lang: int = 2000,
    most_langs: int = 500,
) -> DataFrame:
    """Rows of ``df`` (or its columns ``carry``) with ``lang_pred`` and ``score`` (0 to 1).

    Profiles are learned from the text and language of ``learn_from`` (see learn_profiles);
    only the text of a document decides its prediction, and the whole text counts. A null text or
    one without a letter gives ``und`` and 0, as does learning from no rows. Of languages at the
    same distance the first by name counts. Repeated rows are judged alike, an empty table gives
    an empty result, columns named like the added ones are replaced. Rows of ``learn_from``
    without language or text teach nothing.
    """
    known = Profiles(learn_profiles(learn_from, text, lang, size, docs_per_lang, doc_id, most_langs), size)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    rows = nest(df, carry, p=predict(F.col(f"`{text}`")))
    return unnest(rows.select(ROW, "p.*"), ["lang_pred", "score"])
