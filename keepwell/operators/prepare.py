"""Repair, encode, derive, one-hot: raw accounts to the 60-column table.

Everything is projection only: no shuffle, no Python, one pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepwell import contract as C
from keepwell.functions import features as fx
from keepwell.sources.accounts import numeric_value


def repair(df: DataFrame) -> DataFrame:
    return df.select(*[fx.repaired(c).alias(c) for c in df.columns])


def encode_flags(df: DataFrame) -> DataFrame:
    def encoded(name):
        if name == "Gender":
            return fx.gender_flag().alias(name)
        return fx.yes_no_flag(name).alias(name) if name in C.YES_NO_FIELDS else F.col(name)
    return df.select(*[encoded(c) for c in df.columns])


def derive(df: DataFrame) -> DataFrame:
    first = df.withColumns({n: make() for n, make in fx.FIRST_DERIVED.items()})
    return first.withColumns({n: make() for n, make in fx.SECOND_DERIVED.items()})


def one_hot(df: DataFrame) -> DataFrame:
    """Columns come from the vocabulary, not from the data, so a batch, a
    single record and a stream all get the same twelve."""
    return df.withColumns({
        name: fx.flag(F.col(field) == level)
        for name, (field, level) in C.DUMMIES.items()
    })


def build_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Full chain in the fixed column order; columns the input lacks (identity
    and outcomes of a record to score) are simply absent from the result.
    ``keep`` names further columns to carry."""
    out = df.transform(repair).transform(encode_flags).transform(derive).transform(one_hot)
    return out.select(*[c for c in C.FEATURE_COLUMNS if c in out.columns], *keep)


def score_frame(df: DataFrame) -> DataFrame:
    """Lay a record set of any field subset, in any case, over the raw columns
    a score needs; what is missing or no number becomes a typed NULL."""
    present = {c.lower(): (c, t) for c, t in df.dtypes}

    def field(name):
        kind = C.FIELD[name].kind
        if name.lower() not in present:
            return F.lit(None).cast("string" if kind == "text" else kind)
        sent, dtype = present[name.lower()]
        return F.col(sent).cast("string") if kind == "text" else numeric_value(name, dtype, F.col(sent))

    return df.select(*[field(n).alias(n) for n in (C.ID,) + C.SCORE_INPUTS])


def split_rejected(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows with a blank left anywhere). A tenure of 0 has no
    referral rate and therefore lands in the second set."""
    blank = F.lit(False)
    for c in features.columns:
        blank = blank | F.col(c).isNull()
    return features.where(~blank), features.where(blank)
