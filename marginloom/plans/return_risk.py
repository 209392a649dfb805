"""Return-to-origin risk: features, encoders, model and reports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginloom.functions import scalars as S
from marginloom.operators import encoders as EN
from marginloom.session import shared_dir
from marginloom.sources.tables import materialize

# Fixed values: (shipments above, delivery % below) of the two chronic-return flags.
CHRONIC = {"three_80": (3, 20), "five_70": (5, 30)}
MISSING = -99999.0


def delivery_rates(df: DataFrame, rates: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``delivered * 100 / attempts`` per grain. Zero attempts count as missing."""
    attempts = {den: S.zero_to_null(den) for _, den in rates.values()}
    return df.withColumns(attempts).withColumns({out: S.safe_rate(num, den) for out, (num, den) in rates.items()})


def risk_flags(df: DataFrame, ships: str = "user_del_ship", rate: str = "del_per") -> DataFrame:
    """Users with many shipments and a low delivery rate; NULL where shipments are unknown."""
    return df.withColumns({
        name: S.null_where_null(S.flag((F.col(ships) > n) & (F.col(rate) < pct)), ships)
        for name, (n, pct) in CHRONIC.items()})


def duplicate_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """``flags`` maps output to the duplicate-count column; a missing count is no duplicate."""
    return df.withColumns({out: (S.nz(c, 0) > 0).cast("int") for out, c in flags.items()})


def promise_days(estimated: str, ordered: str):
    return S.days_between(F.to_date(estimated), F.to_date(ordered))


def features(df: DataFrame, rates: Mapping[str, tuple[str, str]], duplicates: Mapping[str, str],
             required: Sequence[str] = ()) -> DataFrame:
    """The shared transform of training, validation and test parts."""
    base = df.dropna(subset=list(required)) if required else df
    base = base.withColumn("user_del_ship", S.zero_to_null("user_del_ship"))
    base = base.withColumn("user_del", S.null_where_null("user_del", "user_del_ship"))
    base = delivery_rates(base, {"del_per": ("user_del", "user_del_ship"), **rates})
    return risk_flags(duplicate_flags(base, duplicates))


def encode_many(train: DataFrame, others: Sequence[DataFrame], categories: Sequence[str], target: str,
                min_count: int = 100, signed: bool = True) -> list[DataFrame]:
    """Club rare categories and encode all columns at once, with everything fitted on ``train`` only.

    The counts of all columns are one scan of ``train``, written to the shared folder; each frame is then encoded by
    a look-up in the weights made from them. Clubbed train values include 'other' itself, so a value unseen in train ends there too.
    """
    spark = train.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/encoder-{uuid.uuid4().hex}"
    counts = materialize(EN.count_many(train, categories, target), f"{folder}/counts")
    dictionary = materialize(EN.weigh_many(counts, min_count, signed=signed), f"{folder}/weights")
    return [EN.apply_many(f, dictionary, categories).fillna(MISSING) for f in (train, *others)]


def encode(train: DataFrame, others: Sequence[DataFrame], categories: Sequence[str], target: str,
           min_count: int = 100, signed: bool = True) -> list[DataFrame]:
    """Club rare categories and encode, with everything fitted on ``train`` only."""
    frames = [train, *others]
    for c in categories:
        frames = [f.withColumn(c, S.as_category(c)) for f in frames]
        # Clubbed train values include 'other' itself, so a value unseen in train also ends there.
        vocab = EN.fit_vocab(frames[0], c, min_count)
        frames = [EN.apply_vocab(f, vocab, c) for f in frames]
        dictionary = EN.fit_woe(frames[0], c, target, signed)
        frames = [EN.apply_woe(f, dictionary, c) for f in frames]
    return [f.fillna(MISSING) for f in frames]
