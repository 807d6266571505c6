"""Series, encoding, metric and model queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import stats
from tidemark.operators.models import ModelSpec, fit
from tidemark.plans import inputs
from tidemark.session import settle
from tidemark.suite.base import query


def _lines(spark, sf_dir):
    return inputs.table(spark, sf_dir, "lineitem")


def _series(spark, sf_dir):
    """Monthly order value, lines shipped, and order value one month later."""
    month = F.trunc("o_orderdate", "month").alias("obs_date")
    orders = (
        inputs.table(spark, sf_dir, "orders")
        .groupBy(month)
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(28,2)").alias("value"))
    )
    shipped = _lines(spark, sf_dir).groupBy(F.trunc("l_shipdate", "month").alias("obs_date")).agg(
        F.count(F.lit(1)).alias("value")
    )
    return orders, shipped, orders.select(F.add_months("obs_date", 1).alias("obs_date"), "value")


_MONTHLY = """o as (select cast(date_trunc('month', o_orderdate) as date) as obs_date,
    cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as value from orders group by 1),
  s as (select cast(date_trunc('month', l_shipdate) as date) as obs_date, count(*) as value from lineitem group by 1),
  p as (select cast(obs_date + interval 1 month as date) as obs_date, value from o)"""


@query(
    "series_align",
    f"""with {_MONTHLY} select o.obs_date, o.value as order_value, s.value as lines_shipped, p.value as order_value_before
    from o join s on s.obs_date = o.obs_date join p on p.obs_date = o.obs_date""",
)
def series_align(spark, sf_dir):
    orders, shipped, before = _series(spark, sf_dir)
    return stats.align_series(
        [
            (orders, "obs_date", "value", "order_value"),
            (shipped, "obs_date", "value", "lines_shipped"),
            (before, "obs_date", "value", "order_value_before"),
        ]
    )


@query(
    "series_overlap",
    f"""with {_MONTHLY}, r as (select 'orders' as series, min(obs_date) as start_date, max(obs_date) as end_date from o
      union all select 'shipped', min(obs_date), max(obs_date) from s union all select 'before', min(obs_date), max(obs_date) from p)
    select * from r union all select 'overlap', max(start_date), min(end_date) from r""",
)
def series_overlap(spark, sf_dir):
    orders, shipped, before = _series(spark, sf_dir)
    return stats.overlap_range(
        [(orders, "obs_date", "orders"), (shipped, "obs_date", "shipped"), (before, "obs_date", "before")]
    )


@query(
    "series_range",
    f"with {_MONTHLY} select obs_date, value from s where obs_date between date '1996-01-01' and date '1999-12-01'",
)
def series_range(spark, sf_dir):
    return stats.filter_range(_series(spark, sf_dir)[1], "obs_date", dt.date(1996, 1, 1), dt.date(1999, 12, 1))


@query(
    "encode_features",
    """select l_orderkey, l_linenumber, case l_linestatus when 'F' then 0.0::double when 'O' then 1.0::double end as l_linestatus_code,
      cast(l_returnflag = 'N' as double) as l_returnflag_N, cast(l_returnflag = 'R' as double) as l_returnflag_R,
      cast(l_linestatus = 'O' as double) as l_linestatus_O from lineitem""",
)
def encode_features(spark, sf_dir):
    """Levels fitted on the lines, stored, and read for both encodings."""
    lines = _lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    levels = stats.fit_levels(lines, ["l_linestatus", "l_returnflag"])
    coded, names = stats.encode_features(lines, levels)
    hot, hot_names = stats.encode_features(coded, levels.filter("feature = 'l_linestatus'"), always_one_hot=True)
    return hot.select("l_orderkey", "l_linenumber", *names, *hot_names)


_SEGMENTS = ["FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "encode_unlisted",
    "select c_custkey, "
    + ", ".join(f"cast(c_mktsegment = '{x}' as double) as own_{x}" for x in _SEGMENTS)
    + ", cast(c_mktsegment = 'BUILDING' as double) as own_other, "
    + ", ".join(f"case when c_mktsegment <> 'BUILDING' then cast(c_mktsegment = '{x}' as double) end as null_{x}" for x in _SEGMENTS)
    + ", case c_mktsegment when 'BUILDING' then -1 when 'FURNITURE' then 1 when 'HOUSEHOLD' then 2 when 'MACHINERY' then 3 end as sparse_index from customer",
)
def encode_unlisted(spark, sf_dir):
    """Levels learned without one segment, met later: as a column of its own, as
    NULL, and as a sparse cell."""
    rows = inputs.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    levels = stats.fit_levels(rows.filter("c_mktsegment <> 'BUILDING'"), ["c_mktsegment"])
    own, names = stats.encode_features(rows, levels, unlisted="own")
    own = own.select("c_custkey", "c_mktsegment", *[F.col(n).alias(n.replace("c_mktsegment", "own")) for n in names])
    both, names = stats.encode_features(own, levels, unlisted="null")
    both = both.select(*own.columns, *[F.col(n).alias(n.replace("c_mktsegment", "null")) for n in names]).drop("c_mktsegment")
    cells = stats.sparse_indicators(rows, ["c_custkey"], "c_mktsegment", levels, unlisted="own")
    sparse = cells.select("c_custkey", F.col("level_index").cast("int").alias("sparse_index"))
    return both.join(sparse, "c_custkey", "left")


@query(
    "regression_metrics",
    """select count(*) as n, round(avg(power(l_extendedprice - l_quantity * 1400, 2)) / 1e6, 6) as mse_millions,
      round(1 - sum(power(l_extendedprice - l_quantity * 1400, 2)) / (var_pop(l_extendedprice) * count(*)), 9) as r2 from lineitem""",
)
def regression_metrics(spark, sf_dir):
    pred = _lines(spark, sf_dir).select(F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1400).alias("y_hat"))
    return stats.regression_metrics(pred).select(
        "n", F.round(F.col("mse") / 1e6, 6).alias("mse_millions"), F.round("r2", 9).alias("r2")
    )


_GUESS = "case when l_quantity > 34 then 'R' when l_quantity > 17 then 'N' else 'A' end"


@query(
    "classification_report",
    f"""with p as (select l_returnflag as actual, {_GUESS} as predicted from lineitem),
    a as (select actual as label, count(*) as support, sum(case when actual = predicted then 1 else 0 end) as hit from p group by 1),
    c as (select predicted as label, count(*) as called from p group by 1),
    r as (select coalesce(a.label, c.label) as label, coalesce(hit, 0) as hit, coalesce(called, 0) as called, coalesce(support, 0) as support
      from a full join c on a.label = c.label),
    m as (select label, support, hit, coalesce(hit / nullif(called, 0), 0) as p, coalesce(hit / nullif(support, 0), 0) as r from r),
    f as (select *, coalesce(2 * p * r / nullif(p + r, 0), 0) as f1 from m)
    select label, round(p, 9) as precision, round(r, 9) as recall, round(f1, 9) as f1, cast(support as bigint) as support from f
    union all select 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9), cast(sum(support) as bigint) from f
    union all select 'macro avg', round(avg(p), 9), round(avg(r), 9), round(avg(f1), 9), cast(sum(support) as bigint) from f
    union all select 'weighted avg', round(sum(p * support) / sum(support), 9), round(sum(r * support) / sum(support), 9),
      round(sum(f1 * support) / sum(support), 9), cast(sum(support) as bigint) from f""",
)
def classification_report(spark, sf_dir):
    report = stats.classification_report(_guesses(spark, sf_dir))
    return report.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


def _guesses(spark, sf_dir):
    return _lines(spark, sf_dir).select(F.col("l_returnflag").alias("actual"), F.expr(_GUESS).alias("predicted"))


@query(
    "confusion_matrix",
    f"select l_returnflag as actual, {_GUESS} as predicted, count(*) as n from lineitem group by 1, 2",
)
def confusion_matrix(spark, sf_dir):
    return stats.confusion(_guesses(spark, sf_dir))


@query(
    "histogram20",
    """with e as (select min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem),
    b as (select least(cast(floor((l_extendedprice - lo) / ((hi - lo) / 20)) as int) + 1, 20) as bin, count(*) as n
      from lineitem, e group by 1)
    select cast(g.bin as int) as bin, round(lo + (g.bin - 1) * ((hi - lo) / 20), 4) as lo, round(lo + g.bin * ((hi - lo) / 20), 4) as hi,
      cast(coalesce(n, 0) as bigint) as count
    from (select unnest(range(1, 21)) as bin) g cross join e left join b on b.bin = g.bin""",
)
def histogram20(spark, sf_dir):
    bins = stats.histogram(_lines(spark, sf_dir), "l_extendedprice", 20)
    return bins.select("bin", F.round("lo", 4).alias("lo"), F.round("hi", 4).alias("hi"), "count")


_OLS = """m as (select count(*) as n, avg(l_extendedprice) as my, avg(l_quantity) as m1, avg(l_discount) as m2,
    var_pop(l_quantity) as s11, var_pop(l_discount) as s22, covar_pop(l_quantity, l_discount) as s12,
    covar_pop(l_quantity, l_extendedprice) as s1y, covar_pop(l_discount, l_extendedprice) as s2y, var_pop(l_extendedprice) as syy from lineitem),
  b as (select *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) as b1, (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) as b2 from m),
  f as (select *, my - b1 * m1 - b2 * m2 as b0, n * (syy - b1 * s1y - b2 * s2y) / (n - 3) as sigma2, s11 * s22 - s12 * s12 as det from b)"""


def _price_spec(model: str = "linear", **kwargs) -> ModelSpec:
    return ModelSpec(
        model, "l_extendedprice", (("l_quantity", "continuous"), ("l_discount", "continuous")), **kwargs
    )


def _significant(col: str, digits: int = 6):
    """Round to significant digits, so both engines agree on sums of doubles."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(F.col(col)))))
    return F.round(F.col(col) * scale).alias(col)


def _sig(expr: str, digits: int = 6) -> str:
    return f"round(({expr}) * power(10.0, {digits - 1} - floor(log10(abs({expr})))))"


_PANELS = 4000


@query(
    "ols_fit",
    f"""with {_OLS}, c as (
      select 'l_quantity' as feature, b1 as value, sqrt(sigma2 * s22 / (n * det)) as std_err from f
      union all select 'l_discount', b2, sqrt(sigma2 * s11 / (n * det)) from f
      union all select 'intercept', b0, sqrt(sigma2 * (1.0 / n + (m1 * m1 * s22 - 2 * m1 * m2 * s12 + m2 * m2 * s11) / (n * det))) from f)
    , t as (select feature, value, std_err, value / std_err as t, (select n - 3.0 from f) as df from c),
    grid as (select unnest(range(0, {_PANELS} + 1)) as i),
    area as (select feature, least(abs(t), 40) / {_PANELS} / 3 * sum((case when i in (0, {_PANELS}) then 1 when i % 2 = 1 then 4 else 2 end)
      * power(1 + power(least(abs(t), 40) / {_PANELS} * i, 2) / df, -(df + 1) / 2)) * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi()) as inside
      from t cross join grid group by feature, t, df)
    select t.feature, {_sig('value')} as value, {_sig('std_err')} as std_err, {_sig('t', 5)} as t_value, abs(round(1 - 2 * inside, 6)) as p_value
    from t join area on area.feature = t.feature""",
)
def ols_fit(spark, sf_dir):
    """Least-squares coefficients to six significant digits (scaled to whole
    numbers). The check integrates the t density by Simpson's rule."""
    result = fit(_lines(spark, sf_dir), _price_spec())
    return result.coefficients.select(
        "feature", _significant("value"), _significant("std_err"), _significant("t_value", 5), F.abs(F.round("p_value", 6)).alias("p_value")
    )


@query(
    "ols_summary",
    f"""with {_OLS}, r as (select n, (b1 * s1y + b2 * s2y) / syy as r2 from f)
    select 'r2' as stat, round(r2, 7) as value from r
    union all select 'r2_adj', round(1 - (1 - r2) * (n - 1) / (n - 3), 7) from r union all select 'n', round(cast(n as double), 7) from r""",
)
def ols_summary(spark, sf_dir):
    return fit(_lines(spark, sf_dir), _price_spec()).summary.select("stat", F.round("value", 7).alias("value"))


@query(
    "ols_predictions",
    f"with {_OLS} select l_extendedprice as y, round(b0 + b1 * l_quantity + b2 * l_discount, 2) as y_hat from lineitem, f",
)
def ols_predictions(spark, sf_dir):
    return fit(_lines(spark, sf_dir), _price_spec()).predictions.select("y", F.round("y_hat", 2).alias("y_hat"))


@query(
    "encode_many_levels",
    """select c_custkey, cast(k - 1 as bigint) as level_index, 1.0::double as value
    from (select c_custkey, dense_rank() over (order by c_name) as k from customer where c_name is not null) x where k > 1""",
)
def encode_many_levels(spark, sf_dir):
    return stats.sparse_indicators(inputs.table(spark, sf_dir, "customer"), ["c_custkey"], "c_name")


@query(
    "range_guard",
    f"""with {_MONTHLY}, r as (select min(obs_date) as a, max(obs_date) as b from o union all select min(obs_date), max(obs_date) from s
      union all select min(obs_date), max(obs_date) from p), v as (select max(a) as lo, min(b) as hi from r)
    select '1993 to 1996' as choice, year(lo) <= 1993 and year(hi) >= 1996 as allowed from v
    union all select '1980 to 1996', year(lo) <= 1980 and year(hi) >= 1996 from v
    union all select '1994-02 to 1995-01', lo <= date '1994-02-01' and hi >= date '1995-01-01' from v
    union all select '1994-02 to 2150-01', lo <= date '1994-02-01' and hi >= date '2150-01-01' from v
    union all select 'all months', true from v union all select 'one month more', false from v
    union all select 'one month before', false from v union all select 'all years', true from v""",
)
def range_guard(spark, sf_dir):
    """Choices of months and years, the first and last that the series share and
    the ones next to them included."""
    overlap = settle(series_overlap(spark, sf_dir), "overlap")
    shared = overlap.filter("series = 'overlap'").first()
    first, last = ((shared[c].year, shared[c].month) for c in ("start_date", "end_date"))
    before, after = ((y + (m + d) // 12, (m + d) % 12 + 1) for (y, m), d in ((first, -2), (last, 0)))
    choices = {
        "1993 to 1996": ("annual", 1993, 1996),
        "1980 to 1996": ("annual", 1980, 1996),
        "1994-02 to 1995-01": ("monthly", (1994, 2), (1995, 1)),
        "1994-02 to 2150-01": ("monthly", (1994, 2), (2150, 1)),
        "all months": ("monthly", first, last),
        "one month more": ("monthly", first, after),
        "one month before": ("monthly", before, last),
        "all years": ("annual", first[0], last[0]),
    }
    found = []
    for name, (frequency, lo, hi) in choices.items():
        try:
            stats.check_range(overlap, *stats.period_bounds(frequency, lo, hi), frequency)
            found.append((name, True))
        except ValueError:
            found.append((name, False))
    return spark.createDataFrame(found, "choice string, allowed boolean")


_SOFT = """m as (select avg(l_extendedprice) as my, avg(l_quantity) as mx, var_pop(l_quantity) as v,
    covar_pop(l_quantity, l_extendedprice) as c from lineitem),
  b as (select a.alpha, my, mx, sign(c) * greatest(abs(c) - a.alpha, 0) / v as b from m cross join (values (20000.0), (1e9)) a(alpha))"""


@query(
    "lasso_fit",
    f"""with {_SOFT} select alpha::double as alpha, 'l_quantity' as feature, round(b, 1) as value from b
    union all select alpha::double, 'intercept', round(my - b * mx, 0) from b""",
)
def lasso_fit(spark, sf_dir):
    """One feature has a closed form: the covariance, less alpha, over the
    variance; a large alpha leaves the mean alone."""
    out = None
    for alpha in (20000.0, 1e9):
        spec = ModelSpec("lasso", "l_extendedprice", (("l_quantity", "continuous"),), alpha=alpha)
        digits = F.when(F.col("feature") == "intercept", F.round("value", 0)).otherwise(F.round("value", 1))
        part = fit(_lines(spark, sf_dir), spec).coefficients.select(F.lit(alpha).alias("alpha"), "feature", digits.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


_ALPHAS = (0.5, 100.0)


@query(
    "lasso_two_features",
    f"""with k as (select avg(l_quantity) as mq, avg(l_discount) as md, covar_pop(l_quantity, l_discount) / var_pop(l_quantity) as k from lineitem),
    x as (select l_extendedprice as y, l_quantity as x1, l_discount - md - k * (l_quantity - mq) as x2 from lineitem, k),
    m as (select var_pop(x1) as v1, var_pop(x2) as v2, covar_pop(x1, y) as c1, covar_pop(x2, y) as c2 from x),
    b as (select alpha, sign(c1) * greatest(abs(c1) - alpha, 0) / v1 as b1, sign(c2) * greatest(abs(c2) - alpha, 0) / v2 as b2
      from m cross join (values {', '.join(f'({a})' for a in _ALPHAS)}) a(alpha))
    select alpha::double as alpha, 'l_quantity' as feature, round(b1, 3) as value from b
    union all select alpha::double, 'discount_beyond', round(b2, 0) + 0.0 from b""",
)
def lasso_two_features(spark, sf_dir):
    """Features that do not correlate are shrunk each on its own: here the
    quantity, and what of the discount the quantity does not explain."""
    lines = _lines(spark, sf_dir)
    slope = F.covar_pop("l_quantity", "l_discount") / F.var_pop("l_quantity")
    mean_q, mean_d, k = lines.agg(F.avg("l_quantity"), F.avg("l_discount"), slope).first()
    data = lines.withColumn("discount_beyond", F.col("l_discount") - mean_d - k * (F.col("l_quantity") - mean_q))
    out = None
    for alpha in _ALPHAS:
        spec = ModelSpec("lasso", "l_extendedprice", (("l_quantity", "continuous"), ("discount_beyond", "continuous")), alpha=alpha)
        digits = F.when(F.col("feature") == "l_quantity", F.round("value", 3)).otherwise(F.round("value", 0) + 0.0)
        part = fit(data, spec).coefficients.filter("feature <> 'intercept'").select(F.lit(alpha).alias("alpha"), "feature", digits.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def _dear(spark, sf_dir):
    """Lines with a 0/1 mark for a high price per unit, the bar rising with the line number."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return _lines(spark, sf_dir).withColumn("dear", (price > 900 + 150 * F.col("l_linenumber")).cast("double"))


_DEAR = "(l_extendedprice / l_quantity > 900 + 150 * l_linenumber)"
_FLAG = (("l_returnflag", "categorical"),)


@query(
    "logit_fit",
    f"""with g as (select l_returnflag as g, count(*) as n, avg(case when {_DEAR} then 1.0 else 0.0 end) as p from lineitem group by 1),
    l as (select g, ln(p / (1 - p)) as l, 1 / (n * p * (1 - p)) as v from g), a as (select * from l where g = 'A')
    select 'l_returnflag_' || l.g as feature, round(l.l - a.l, 6) as value, round(sqrt(l.v + a.v), 6) as std_err from l, a where l.g <> 'A'
    union all select 'intercept', round(l, 6), round(sqrt(v), 6) from a""",
)
def logit_fit(spark, sf_dir):
    """With one category the coefficients are differences of log odds."""
    result = fit(_dear(spark, sf_dir), ModelSpec("logistic", "dear", _FLAG))
    return result.coefficients.select("feature", F.round("value", 6).alias("value"), F.round("std_err", 6).alias("std_err"))


@query(
    "probit_fit",
    f"""select round(p, 6) as rate, n, dear from (select avg(case when {_DEAR} then 1.0 else 0.0 end) as p, count(*) as n,
      sum(case when {_DEAR} then 1.0 else 0.0 end)::double as dear from lineitem group by l_returnflag) x""",
)
def probit_fit(spark, sf_dir):
    """With one category the fitted probabilities are the rates of its levels."""
    fitted = fit(_dear(spark, sf_dir), ModelSpec("probit", "dear", _FLAG)).predictions
    return fitted.groupBy(F.round("y_hat", 6).alias("rate")).agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("dear"))


_BY_LINE = (("l_linenumber", "continuous"),)


@query(
    "rf_classify",
    f"""with g as (select l_linenumber as g, avg(case when {_DEAR} then 1.0 else 0.0 end) > 0.5 as yes from lineitem group by 1)
    select case when {_DEAR} then 1.0 else 0.0 end::double as y, case when yes then 1.0 else 0.0 end::double as y_hat, count(*) as n
    from lineitem join g on g.g = l_linenumber group by 1, 2""",
)
def rf_classify(spark, sf_dir):
    """A single tree grown to the end on a few values predicts each one's majority."""
    fitted = fit(_dear(spark, sf_dir), ModelSpec("rf_classification", "dear", _BY_LINE, n_estimators=1, resample=False)).predictions
    return fitted.groupBy("y", "y_hat").agg(F.count(F.lit(1)).alias("n"))


@query(
    "rf_regress",
    "select round(avg(l_extendedprice), 2) as y_hat, count(*) as n from lineitem group by l_linenumber",
)
def rf_regress(spark, sf_dir):
    """A single tree grown to the end on a few values predicts each one's mean."""
    spec = ModelSpec("rf_regression", "l_extendedprice", _BY_LINE, n_estimators=1, resample=False)
    fitted = fit(_lines(spark, sf_dir), spec).predictions
    return fitted.groupBy(F.round("y_hat", 2).alias("y_hat")).agg(F.count(F.lit(1)).alias("n"))


_FOREST = (("l_linenumber", "continuous"), ("l_quantity", "continuous"), ("l_returnflag", "categorical"))


@query(
    "rf_many_trees",
    """with n as (select count(*)::double as n from lineitem), m as (select unnest(['rf_classification', 'rf_regression']) as model)
    select model, 'rows' as measure, n as value from m, n union all select model, 'trees', 20.0 from m
    union all select model, 'importance', 1.0 from m union all select model, 'negative_importances', 0.0 from m
    union all select model, 'beats_a_constant', 1.0 from m""",
)
def rf_many_trees(spark, sf_dir):
    """Resampled forests have no closed form; these must hold of any: a
    prediction for every row, importances that are shares, and a smaller error
    than the best constant's."""
    out = None
    for model, y in (("rf_classification", "dear"), ("rf_regression", "l_extendedprice")):
        result = fit(_dear(spark, sf_dir), ModelSpec(model, y, _FOREST, n_estimators=20, max_depth=8))
        error = F.avg(F.pow(F.col("y") - F.col("y_hat"), 2))
        constant = F.least(F.avg("y"), 1 - F.avg("y")) if model == "rf_classification" else F.var_pop("y")
        seen = result.predictions.agg(F.count(F.lit(1)).cast("double").alias("rows"), (error < constant).cast("double").alias("beats_a_constant"))
        shares = result.coefficients.agg(
            F.round(F.sum("value"), 6).alias("importance"), F.count(F.when(F.col("value") < 0, 1)).cast("double").alias("negative_importances")
        )
        trees = result.summary.filter("stat = 'trees'").select(F.lit("trees").alias("measure"), "value")
        for part in (seen.unpivot([], seen.columns, "measure", "value"), shares.unpivot([], shares.columns, "measure", "value"), trees):
            row = part.select(F.lit(model).alias("model"), "measure", "value")
            out = row if out is None else out.unionByName(row)
    return out
