"""Column functions for dirty text: blanks, codes, phones, tags, tolerant casts and keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of the brokerage feeds.
STATUS = {"ACTV": "Active", "CMPT": "Completed", "CNCL": "Canceled", "PNDG": "Pending", "SBMT": "Submitted", "INAC": "Inactive"}
TRADE_TYPE = {"TMB": "Market Buy", "TMS": "Market Sell", "TSL": "Stop Loss", "TLS": "Limit Sell", "TLB": "Limit Buy"}
ACTION_STATUS = {"NEW": "Active", "ADDACCT": "Active", "UPDACCT": "Active", "UPDCUST": "Active", "CLOSEACCT": "Inactive", "INACT": "Inactive"}
RATINGS = ("AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-", "BB+", "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D")
#: Grades from here on are low ones.
FIRST_LOW_GRADE = "BB+"
OPEN_END = "9999-12-31"

Name = Column | str


def _c(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


def map_codes(col: Name, codes: Mapping[str, str], passthrough: bool = False) -> Column:
    """The label of a code; an unknown code gives null, or itself with ``passthrough``."""
    labels = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    found = F.try_element_at(labels, _c(col))
    return F.coalesce(found, _c(col)) if passthrough else found


def blank_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become null, in the given columns or in all text columns."""
    names = cols or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({n: F.nullif(df[n], F.lit("")) for n in names})


def phone(country: Name, area: Name, local: Name, ext: Name) -> Column:
    """``+country (area) local ext``; parts that are blank are left out, no local number gives null."""
    full = lambda x: F.nullif(_c(x), F.lit(""))
    return F.when(
        full(local).isNotNull(),
        F.concat(F.coalesce(F.concat(F.lit("+"), full(country), F.lit(" ")), F.lit("")), F.coalesce(F.concat(F.lit("("), full(area), F.lit(") ")), F.lit("")), full(local), F.coalesce(full(ext), F.lit(""))),
    )


def gender(col: Name) -> Column:
    up = F.upper(_c(col))
    return F.when(up.isin("M", "F"), up).otherwise("U")


def valid_rating(col: Name) -> Column:
    return F.when(_c(col).isin(*RATINGS), _c(col))


def low_grade(col: Name) -> Column:
    """False from BBB- upward, true below, null where the rating is none."""
    low = RATINGS.index(FIRST_LOW_GRADE)
    return F.when(_c(col).isin(*RATINGS[:low]), False).when(_c(col).isin(*RATINGS[low:]), True)


def tags(rules: Sequence[tuple[str, Column]]) -> Column:
    """Names of the rules that hold, joined by ``+``; a rule that is null doesn't hold; none gives ''."""
    return F.concat_ws("+", *[F.when(cond, F.lit(name)) for name, cond in rules])


def marketing_rules() -> list[tuple[str, Column]]:
    """The prospect tags and their rules (fixed names and limits); incomes that are no numbers count as unknown."""
    income = F.expr("try_cast(income AS long)")
    return [
        ("HighValue", (F.col("networth") > 1_000_000) | (income > 200_000)),
        ("Expenses", (F.col("numberchildren") > 3) | (F.col("numbercreditcards") > 5)),
        ("Boomer", F.col("age") > 45),
        ("MoneyAlert", (income < 50_000) | (F.col("creditrating") < 600) | (F.col("networth") < 100_000)),
        ("Spender", (F.col("numbercars") > 3) | (F.col("numbercreditcards") > 7)),
        ("Inherited", (F.col("age") < 25) & (F.col("networth") > 1_000_000)),
    ]


def marketing_tags() -> Column:
    """The tags of ``marketing_rules`` that a prospect has."""
    return tags(marketing_rules())


def safe_ratio(a: Name, b: Name) -> Column:
    """a / b, null where b is zero or either is null."""
    return F.try_divide(_c(a), _c(b))


def date_key(col: Name) -> Column:
    return F.date_format(_c(col), "yyyyMMdd").cast("long")


def time_key(col: Name) -> Column:
    return F.date_format(_c(col), "HHmmss").cast("long")


def version_key(start: Name, key: Name) -> Column:
    """The key of one version: the day it starts, followed by the natural key."""
    return F.concat(F.date_format(_c(start), "yyyyMMdd"), _c(key).cast("string")).cast("long")


def natural_key(version: Name) -> Column:
    """The natural key of a version key."""
    return F.substring(_c(version).cast("string"), 9, 20).cast("long")


def id_or_name(col: Name) -> Column:
    """References that are numbers lose their leading zeros; names stay."""
    return F.coalesce(_c(col).try_cast("long").cast("string"), _c(col))


def tolerant(col: Name, kind: str, fmt: str | None = None) -> Column:
    """Cast that gives null for what can't be read (after trimming)."""
    text = F.trim(_c(col))
    if kind == "date":
        return F.try_to_timestamp(text, F.lit(fmt or "yyyyMMdd")).cast("date")
    return text.try_cast(kind)
