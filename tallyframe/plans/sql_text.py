"""SQL pieces shared by the catalogue's DuckDB side."""

from __future__ import annotations

from tallyframe.functions.columns import NUMBER_TEXT
from tallyframe.plans.views import DUCK, dirty_sql

DIRTY = f"({dirty_sql(DUCK)})"


def number(x: str) -> str:
    return f"(case when regexp_matches({x}, '{NUMBER_TEXT}') then try_cast(trim({x}) as double) end)"


def digits(x: str) -> str:
    return f"try_cast(nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '') as double)"


def months(x: str) -> str:
    shape = r"(\d+)\s+Years?\s+and\s+(\d+)\s+Months?"
    return (f"(try_cast(nullif(regexp_extract({x}, '{shape}', 1), '') as int) * 12 "
            f"+ try_cast(nullif(regexp_extract({x}, '{shape}', 2), '') as int))")


def clip(x: str, lo: float | None, hi: float | None) -> str:
    out = f"case when {x} is null then null"
    if lo is not None:
        out += f" when {x} < {lo} then cast({lo} as double)"
    if hi is not None:
        out += f" when {x} > {hi} then cast({hi} as double)"
    return out + f" else {x} end"


def label_code(x: str) -> str:
    return (f"cast(case {x} when 'Poor' then 0 when 'Standard' then 1 "
            f"when 'Good' then 2 end as int)")


# The demo rules without the fitted cap, keys kept.
CLEAN = f"""(select id,
  case when {digits('age_txt')} between 18 and 100 then {digits('age_txt')} end as age_txt,
  {number("replace(income_txt, '_', '')")} as income_txt,
  {clip(number("replace(loans_txt, '_', '')"), 0, 10)} as loans_txt,
  {number("nullif(limit_txt, '_')")} as limit_txt,
  {number("nullif(balance_txt, '__-333333333333333333333333333__')")} as balance_txt,
  {months('history_txt')} as history_txt,
  salary, {clip('cast(cards as double)', 0, 20)} as cards,
  nullif(occupation, '_______') as occupation, nullif(mix, '_') as mix,
  {label_code('label')} as label
from {DIRTY})"""

TRAIN = "id % 10 < 7"

CAPPED = f"""(select * replace (case when income_txt > cap then cap else income_txt end as income_txt)
  from {CLEAN} cross join (select quantile_cont(income_txt, 0.99) as cap
                           from {CLEAN} where {TRAIN}))"""


def unpivot(columns: list[str], source: str, keep: str = "") -> str:
    return " union all ".join(
        f"select {keep}'{c}' as feature, cast({c} as varchar) as value from {source}" for c in columns)
