"""Feature engineering: state is fitted on training rows and replayed unchanged."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyframe.functions import columns as fx
from tallyframe.operators.cleaning import CleanRules, clean
from tallyframe.operators.dictionary import Dictionary
from tallyframe.operators.order import quantile_table, rank_neighbours, settle
from tallyframe.sources.tables import scratch_path

#: A column with more values is not spread over columns of its own but kept as one sparse vector.
MAX_CATEGORIES = 1000
MIN_VARIANCE = 0.01


def ratio_sql(a: str, b: str) -> str:
    """a / b, 0 where the denominator is zero or either side is missing."""
    return f"coalesce(({a}) / nullif(cast({b} as double), 0D), 0D)"


def add_features(df: DataFrame, table: Mapping[str, str]) -> DataFrame:
    """Ordered name-to-expression table applied in one projection."""
    return df.withColumns({name: F.expr(text) for name, text in table.items()})


# -- imputation ---------------------------------------------------------------

def fit_medians(train: DataFrame, columns: Sequence[str], rows: int | None = None
                ) -> dict[str, float]:
    cols = [c for c in columns if c in train.columns]
    found = quantile_table(train, cols, [0.5], rows=rows) if cols else {}
    return {c: v[0] for c, v in found.items()}


def fit_caps_and_medians(train: DataFrame, rules: CleanRules, columns: Sequence[str]
                         ) -> tuple[int, dict[str, float], dict[str, float]]:
    """Rows, caps of cleaned rows, and medians of the rows they cap, from one set of order statistics.

    A cap keeps the order, so the two values next to a median are capped instead of all rows. NaN
    and infinity are above every cap: a column that has some is looked at again after capping.
    """
    cleaned = clean(train, rules)
    capped = {c: q for c, q in rules.quantile_caps.items() if c in cleaned.columns}
    middle = [c for c in columns if c in cleaned.columns]
    floats = [c for c in capped if isinstance(cleaned.schema[c].dataType, (T.DoubleType, T.FloatType))]
    row = cleaned.agg(F.count("*").alias("__rows"), *[
        F.count_if(F.col(c).isNotNull() & fx.finite(c).isNull()).alias(c) for c in floats]).first()
    rows, wanted = row["__rows"], list(dict.fromkeys([*capped, *middle]))
    levels = [0.5, *sorted(set(capped.values()) - {0.5})]
    found = rank_neighbours(cleaned, wanted, levels, rows=rows) if wanted else {}
    caps = {}
    for c in capped:
        if c in found:
            a, b, share, _ = found[c][1][levels.index(capped[c])]
            caps[c] = a + (b - a) * share
    medians = {}
    for c in middle:
        if c in found:
            a, b, share, _ = found[c][1][0]
            if c in caps and not isinstance(cleaned.schema[c].dataType, T.StringType):
                a, b = min(a, caps[c]), min(b, caps[c])
            medians[c] = a + (b - a) * share
    endless = [c for c in floats if row[c] and c in middle]
    if endless:
        medians.update(fit_medians(clean(train, rules, caps), endless, rows))
    return rows, caps, medians


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (texts.unpivot([], list(columns), "feature", "value")
            .where(F.col("value").isNotNull()).groupBy("feature", "value")
            .agg(F.count("*").alias("n")))


def fit_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, the smallest on ties, "" when all are missing."""
    cols = [c for c in columns if c in train.columns]
    if not cols:
        return {}
    return _modes(value_counts(train, cols), cols)


def _modes(counts: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    best = counts.groupBy("feature").agg(
        F.expr("min(struct(-n as minus_n, value)).value").alias("value"))
    found = {r["feature"]: r["value"] for r in best.collect()}
    return {c: found.get(c, "") for c in columns}


def modes_and_categories(counts: DataFrame, modes: Sequence[str], categories: Sequence[str]
                         ) -> tuple[dict[str, str], dict[str, list[str]], list[str]]:
    """Modes, values of the columns with few of them, and names of the columns with many.

    A small table of counts is fetched once, for both; a large one is reduced where it lies.
    """
    small = settle(counts)
    if small is counts:
        return _modes(counts, modes), *_categories(counts, categories)
    seen: dict[str, list[tuple[int, str]]] = {}
    for r in small.collect():
        seen.setdefault(r["feature"], []).append((-r["n"], r["value"]))
    wide = [c for c in categories if len(seen.get(c, ())) > MAX_CATEGORIES]
    return ({c: min(seen[c])[1] if c in seen else "" for c in modes},
            {c: sorted(v for _, v in seen.get(c, ())) for c in categories if c not in wide}, wide)


def fill(df: DataFrame, values: Mapping[str, float | str]) -> DataFrame:
    """Replace NULLs by fitted values; numbers come out as doubles."""
    out = {}
    for c, v in values.items():
        if c not in df.columns:
            continue
        base = F.col(c) if isinstance(v, str) else F.col(c).cast("double")
        out[c] = F.coalesce(base, F.lit(v))
    return df.withColumns(out) if out else df


def residual_fill(df: DataFrame, medians: Mapping[str, float], columns: Sequence[str]) -> DataFrame:
    """Leftover NULLs of feature columns: training median first, then 0."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians.get(c, 0.0)))) for c in columns})


# -- encoding -----------------------------------------------------------------

def fit_categories(train: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted training categories. They turn into columns, so their number is checked."""
    cols = [c for c in columns if c in train.columns]
    found, wide = _categories(value_counts(train, cols), cols) if cols else ({}, [])
    if wide:
        raise ValueError(f"{', '.join(wide)}: too many categories for one column each; "
                         "wide_one_hot makes one sparse vector of them")
    return found


def _categories(counts: DataFrame, columns: Sequence[str]) -> tuple[dict[str, list[str]], list[str]]:
    """(values of the columns with few of them, names of the others); only the former are collected."""
    own = counts.where(F.col("feature").isin(*columns))
    sizes = {r["feature"]: r["n"] for r in own.groupBy("feature").agg(F.count("*").alias("n")).collect()}
    wide = [c for c in columns if sizes.get(c, 0) > MAX_CATEGORIES]
    found: dict[str, list[str]] = {c: [] for c in columns if c not in wide}
    for r in own.where(F.col("feature").isin(*found)).select("feature", "value").collect() if found else []:
        found[r["feature"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}, wide


def one_hot_columns(column: str, categories: Sequence[str], drop_first: bool = False
                    ) -> dict[str, Column]:
    kept = list(categories)[1:] if drop_first else list(categories)
    return {f"{column}_{v}": F.coalesce(F.col(column) == v, F.lit(False)) for v in kept}


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]], drop_first: bool = False
            ) -> DataFrame:
    """Replace each column by booleans; NULL and unseen values are false everywhere."""
    gone = [c for c in categories if c in df.columns]
    new: dict[str, Column] = {}
    for c in gone:
        new.update(one_hot_columns(c, categories[c], drop_first))
    return df.select(*[F.col(c) for c in df.columns if c not in gone],
                     *[e.alias(n) for n, e in new.items()])


def wide_one_hot(train: DataFrame, columns: Sequence[str]) -> Dictionary:
    """Any number of categories: its ``transform`` adds a sparse vector ``<column>_vector`` per column.

    Training categories in the order of their bytes; NULL and unseen values are zero everywhere.
    """
    return Dictionary.fit(train, columns)


def align(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; absent ones are 0."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(0).alias(c) for c in columns])


# -- selection ----------------------------------------------------------------

def select_explicit(df: DataFrame, fitted: Sequence[str], label: str | None = None) -> DataFrame:
    tail = [label] if label and label in df.columns and label not in fitted else []
    return align(df, [*fitted, *tail])


def variances(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    row = df.agg(*[F.var_samp(F.col(f"`{c}`").cast("double")).alias(c) for c in columns]).first()
    return row.asDict()


def select_by_variance(train: DataFrame, threshold: float = MIN_VARIANCE, label: str | None = None,
                       include_boolean: bool = False, columns: Sequence[str] | None = None
                       ) -> list[str]:
    """Names kept: all but numeric columns whose sample variance is below the threshold.

    Booleans count as non-numeric unless ``include_boolean``; the label is exempt.
    """
    names = list(columns or train.columns)
    kinds = (T.NumericType, T.BooleanType) if include_boolean else (T.NumericType,)
    checked = [c for c in names if c != label and isinstance(train.schema[c].dataType, kinds)]
    found = _variances_any(train, checked)
    return [c for c in names if c not in checked
            or not (found[c] is not None and found[c] < threshold)]


def _variances_any(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    if not columns:
        return {}
    numbers = df.select(*[
        (F.col(f"`{c}`").cast("int") if isinstance(df.schema[c].dataType, T.BooleanType)
         else F.col(f"`{c}`")).alias(c) for c in columns])
    return variances(numbers, columns)


# -- the whole chain ----------------------------------------------------------

@dataclass(frozen=True)
class FeatureSpec:
    rules: CleanRules
    numeric: Sequence[str]
    categorical: Sequence[str]
    ordinal: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    one_hot: Sequence[str] = ()
    drop: Sequence[str] = ()
    derived: Mapping[str, str] = field(default_factory=dict)
    selected: Sequence[str] | None = None
    min_variance: float = MIN_VARIANCE
    label: str | None = None
    wide: Sequence[str] = ()


@dataclass(frozen=True)
class FittedFeatures:
    """Everything learnt from training rows; small, JSON-serialisable."""

    spec: FeatureSpec
    caps: dict[str, float] = field(default_factory=dict)
    medians: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)
    features: list[str] = field(default_factory=list)
    residual_medians: dict[str, float] = field(default_factory=dict)
    dictionary: dict | None = None

    @property
    def wide(self) -> list[str]:
        """Columns that stay one sparse vector each, ``<column>_vector``."""
        return list(self.dictionary["sizes"]) if self.dictionary else []

    @property
    def inputs(self) -> list[str]:
        """What a model is fitted on, in order: features, then the vectors of wide columns."""
        return [*self.features, *(f"{c}_vector" for c in self.wide)]

    @classmethod
    def fit(cls, train: DataFrame, spec: FeatureSpec, written: bool = False) -> "FittedFeatures":
        """Training rows are written once; all passes read that table, not their source.

        ``written`` says that ``train`` is read from a table as it is.
        """
        if not written:
            path, schema = scratch_path(train.sparkSession, "fit"), train.schema
            train.write.parquet(path)
            train = train.sparkSession.read.schema(schema).parquet(path)
        rows, caps, medians = fit_caps_and_medians(train, spec.rules, spec.numeric)
        cleaned = clean(train, spec.rules, caps)
        text = [c for c in {*spec.categorical, *spec.one_hot} if c in cleaned.columns]
        modes, categories, wide = modes_and_categories(
            value_counts(cleaned, text), [c for c in spec.categorical if c in text],
            [c for c in spec.one_hot if c in text]) if text else ({}, {}, [])
        wide = [*wide, *(c for c in spec.wide if c in cleaned.columns and c not in wide)]
        for c in categories:  # a column without any value is filled with its mode ""
            categories[c] = categories[c] or [modes[c]] if c in modes else categories[c]
        coded = asdict(Dictionary.fit(cleaned, wide)) if wide else None
        state = cls(spec, caps, medians, modes, categories, dictionary=coded)
        derived = state.derive(state.encode(state.impute(cleaned)))
        wanted = spec.selected if spec.selected is not None else derived.columns
        listed = [c for c in wanted if c in derived.columns and c != spec.label and c not in wide]
        kept = select_by_variance(derived, spec.min_variance, spec.label, columns=listed)
        open_ = [c for c in kept if derived.schema[c].nullable]  # imputed columns never are
        return replace(state, features=kept, residual_medians=fit_medians(derived, open_, rows))

    def impute(self, cleaned: DataFrame) -> DataFrame:
        return fill(cleaned, {**self.medians, **self.modes})

    def encode(self, imputed: DataFrame) -> DataFrame:
        df = imputed.drop(*[c for c in self.spec.drop if c in imputed.columns])
        df = df.withColumns({c: fx.map_label(c, m) for c, m in self.spec.ordinal.items()
                             if c in df.columns})
        return one_hot(df, self.categories)

    def derive(self, encoded: DataFrame) -> DataFrame:
        return add_features(encoded, self.spec.derived)

    def training_matrix(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Features and label for fitting; leftover NULLs get training medians, then 0."""
        out = self._features(df, [*keep, self.spec.label])
        return residual_fill(out, self.residual_medians, self.features)

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Scoring-time features in training order, NULLs 0, label dropped. No shuffle, but for wide columns.

        ``keep`` names input columns (keys) carried along untouched.
        """
        return residual_fill(self._features(df, keep), {}, self.features)

    def _features(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        keep = [c for c in keep if c and c in df.columns]
        carried = {f"__keep_{c}": F.col(c) for c in keep if c != self.spec.label}
        cleaned = clean(df.withColumns(carried) if carried else df, self.spec.rules, self.caps)
        imputed = self.impute(cleaned)
        if self.dictionary:
            imputed = imputed.withColumns({f"__wide_{c}": F.col(c) if c in imputed.columns else F.lit(None).cast("string")
                                           for c in self.wide})
        built = self.derive(self.encode(imputed))
        names = [*[f"__keep_{c}" if c != self.spec.label else c for c in keep], *self.features]
        if not self.dictionary:
            out = align(built, names)
        else:
            coded = Dictionary(**self.dictionary).transform(align(built, [*names, *(f"__wide_{c}" for c in self.wide)]
                                                                  ).withColumnsRenamed({f"__wide_{c}": c for c in self.wide}))
            out = coded.drop(*self.wide)
        return out.withColumnsRenamed({f"__keep_{c}": c for c in keep})

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=False)

    @classmethod
    def from_json(cls, text: str) -> "FittedFeatures":
        raw = json.loads(text)
        spec = raw.pop("spec")
        rules = spec.pop("rules")
        for name in ("valid_ranges", "bounds"):
            rules[name] = {c: tuple(v) for c, v in rules[name].items()}
        return cls(spec=FeatureSpec(rules=CleanRules(**rules), **spec), **raw)
