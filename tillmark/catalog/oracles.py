"""Equivalent DuckDB SQL for the registered queries."""

from __future__ import annotations

from itertools import combinations

from tillmark.functions import distributions
from tillmark.operators import clustering, normality

SEED = 7

RAW = """
raw as (
  select o_orderdate + to_seconds(l_orderkey * 7919 % 86400) as fecha,
    case o_orderpriority when '1-URGENT' then 'APP' when '2-HIGH' then 'WEB' when '3-MEDIUM' then 'CCT' else 'POS' end as canal,
    cast(l_partkey as double) as sku, p_name as producto,
    case when l_partkey % 307 = 0 then 0.0::double else l_quantity end as unidades,
    case when l_partkey % 53 = 0 then null when l_partkey % 211 = 0 then 1.17::double else l_discount end as porcentaje_descuento,
    l_extendedprice * (1 - l_discount) as monto_aplicado,
    l_orderkey as boleta, cast(l_suppkey as double) as local,
    cast(o_custkey as varchar) as codigo_cliente, c_name as run_cliente,
    case when o_custkey % 97 <> 0 then cast(date '1890-01-01' + cast(o_custkey * 7919 % 45000 as integer) as timestamp) end as fecha_nacimiento,
    case when o_custkey % 89 <> 0 then cast(1 + o_custkey % 2 as double) end as genero
  from lineitem join orders on l_orderkey = o_orderkey
  left join part on l_partkey = p_partkey left join customer on o_custkey = c_custkey
)"""

VALID = """
valid as (
  select * replace (coalesce(porcentaje_descuento, 0.0::double) as porcentaje_descuento) from raw
  where monto_aplicado is not null and unidades is not null and fecha is not null
    and unidades > 0 and monto_aplicado >= 0 and boleta > 0
    and coalesce(porcentaje_descuento, 0.0) between 0 and 1
),
fills as (
  select timestamp '1970-01-01' + to_seconds(cast(round(median(epoch(fecha_nacimiento))) as bigint)) as median_birth,
    (select genero from valid where genero is not null group by genero order by count(*) desc, genero limit 1) as gender_mode
  from valid
)"""

CLEAN = """
clean as (
  select * replace (
    coalesce(fecha_nacimiento, (select median_birth from fills)) as fecha_nacimiento,
    coalesce(genero, (select gender_mode from fills)) as genero)
  from valid
),
aged as (select *, round_even(floor((epoch(fecha) - epoch(fecha_nacimiento)) / 86400.0) / 365.25, 1) as age0 from clean),
age_fill as (
  select coalesce(median(age0) filter (where age0 between 0 and 100), median(age0)) as median_age from aged
)"""

FEAT = """
feat as (
  select fecha, canal, sku, unidades, porcentaje_descuento, monto_aplicado, boleta, local, codigo_cliente,
    fecha_nacimiento, genero, monto_aplicado / unidades as monto_por_unidad,
    case when age0 < 0 or age0 > 100 then (select median_age from age_fill) else age0 end as edad,
    count(distinct boleta) over (partition by codigo_cliente) as frecuencia_compra,
    count(*) over (partition by boleta) as items_por_boleta,
    cast(hour(fecha) as integer) as hora, cast(isodow(fecha) - 1 as integer) as dia_semana,
    cast(month(fecha) as integer) as mes, cast(year(fecha) as integer) as anio,
    isodow(fecha) >= 6 as es_fin_de_semana
  from aged
)"""


def _with(ctes: list[str], body: str) -> str:
    return "with " + ",".join(ctes) + "\n" + body


def on_raw(body: str, *more: str) -> str:
    return _with([RAW, *more], body)


def on_valid(body: str, *more: str) -> str:
    return _with([RAW, VALID, *more], body)


def on_clean(body: str, *more: str) -> str:
    return _with([RAW, VALID, CLEAN, *more], body)


def on_feat(body: str, *more: str) -> str:
    return _with([RAW, VALID, CLEAN, FEAT, *more], body)


RAW_COLUMNS = """fecha, canal, sku, producto, unidades, porcentaje_descuento, round(monto_aplicado, 4) as monto_aplicado,
  boleta, local, codigo_cliente, run_cliente, fecha_nacimiento, genero"""

HASH = (
    "cast('0x' || substr(md5(concat_ws(':', boleta, cast(sku as bigint), cast(local as bigint), "
    f"cast(floor(monto_aplicado * 100) as bigint), '{SEED}')), 1, 15) as ubigint)"
)
CLIENT_HASH = f"cast('0x' || substr(md5(concat_ws(':', codigo_cliente, '{SEED}')), 1, 15) as ubigint)"

DESCRIBED = [
    "sku", "unidades", "porcentaje_descuento", "monto_aplicado", "boleta", "local", "genero", "monto_por_unidad",
    "edad", "frecuencia_compra", "items_por_boleta", "hora", "dia_semana", "mes", "anio",
]
CHART_COLUMNS = ["unidades", "monto_aplicado", "porcentaje_descuento", "monto_por_unidad"]
TEST_COLUMNS = ["unidades", "monto_aplicado", "porcentaje_descuento"]


def _union(parts: list[str]) -> str:
    return "\nunion all\n".join(parts)


def _missing(source: str, columns: dict[str, str]) -> str:
    parts = [
        f"select '{c}' as \"column\", count(*) - count({c}) as n_missing, "
        f"round_even((count(*) - count({c})) * 100.0 / count(*), 2)::double as pct_missing, '{t}' as dtype from {source}"
        for c, t in columns.items()
    ]
    return f"select * from ({_union(parts)}) where n_missing > 0 order by pct_missing desc, \"column\""


TYPES_BEFORE = {"porcentaje_descuento": "double", "fecha_nacimiento": "timestamp_ntz", "genero": "double", "fecha": "timestamp_ntz",
                "canal": "string", "sku": "double", "unidades": "double", "monto_aplicado": "double", "boleta": "bigint",
                "local": "double", "codigo_cliente": "string"}


NUMERIC_BEFORE = [c for c, kind in TYPES_BEFORE.items() if kind in ("double", "bigint")]


def _null_phi(a: str, b: str) -> str:
    x, y = (f"case when {c} is null then 1.0::double else 0.0::double end" for c in (a, b))
    return f"abs(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0))"


def _describe() -> str:
    parts = []
    for c in DESCRIBED:
        x = f"cast({c} as double)"
        constant = f"min({c}) = max({c})"
        parts.append(
            f"select '{c}' as variable, count({c}) as count, round_even(avg({x}), 4) as mean, round_even(stddev_samp({x}), 4) as std, "
            f"round_even(min({x}), 4) as min, round_even(quantile_cont({x}, 0.25), 4) as p25, round_even(quantile_cont({x}, 0.5), 4) as p50, "
            f"round_even(quantile_cont({x}, 0.75), 4) as p75, round_even(max({x}), 4) as max, "
            f"case when {constant} then 0.0 else round_even(skewness({x}), 4) end as skewness, "
            f"case when {constant} then 0.0 else round_even(kurtosis({x}), 4) end as kurtosis from feat"
        )
    return _union(parts)


def _outliers(column: str) -> str:
    return f"""
select '{column}' as "column", count(*) filter (where i) as n_iqr_outliers, round_even(count(*) filter (where i) * 100.0::double / count(*), 2) as pct_iqr_outliers,
  count(*) filter (where z) as n_zscore_outliers, round_even(count(*) filter (where z) * 100.0::double / count(*), 2) as pct_zscore_outliers
from (select {column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1) as i,
        coalesce(abs(({column} - m) / nullif(s, 0)) > 3, false) as z
      from feat, (select quantile_cont({column}, 0.25) as q1, quantile_cont({column}, 0.75) as q3,
                    avg({column}) as m, stddev_pop({column}) as s from feat))"""


DAILY = """
sold as (select cast(fecha as date) as day, sum(monto_aplicado) as sales from feat group by 1),
daily as (
  select c.day, coalesce(s.sales, 0.0) as sales
  from (select cast(unnest(generate_series(min(day)::timestamp, max(day)::timestamp, interval 1 day)) as date) as day from sold) c
  left join sold s on c.day = s.day
),
seq as (select 0 as g, row_number() over (order by day) - 1 as i, day, sales, sales - avg(sales) over () as x, count(*) over () as n from daily)"""

DAILY_BY_CHANNEL = """
sold as (select canal, cast(fecha as date) as day, sum(monto_aplicado) as sales from feat group by 1, 2),
daily as (
  select c.canal, c.day, coalesce(s.sales, 0.0) as sales
  from (select canal, cast(unnest(generate_series(min(day)::timestamp, max(day)::timestamp, interval 1 day)) as date) as day from sold group by canal) c
  left join sold s on c.day = s.day and c.canal = s.canal
),
seq as (select canal as g, row_number() over (partition by canal order by day) - 1 as i, sales - avg(sales) over (partition by canal) as x,
          count(*) over (partition by canal) as n from daily)"""

ACF = """
lagged as (
  select a.g, max(a.n) as n, cast(k.lag as integer) as lag, sum(a.x * b.x) as ck
  from seq a, (select unnest(range(0, 41)) as lag) k, seq b where b.i = a.i + k.lag and a.g = b.g group by a.g, k.lag
),
acf as (select l.g, l.n, l.lag, l.ck / z.ck as acf from lagged l join lagged z on z.lag = 0 and z.g = l.g),
banded as (
  select *, case when lag = 0 then 0.0 else 1.959963984540054 * sqrt((1 + 2 * coalesce(sum(case when lag > 0 then acf * acf else 0 end)
    over (partition by g order by lag rows between unbounded preceding and 1 preceding), 0)) / n) end as half from acf
)"""

PACF = """
ac as (select list(acf order by lag) as r, max(n) as n from acf),
ld(k, phi, rest, p) as (
  select 0, cast([] as double[]), 1.0::double, 1.0::double
  union all
  select k + 1,
    list_append(list_transform(range(1, k + 1), lambda j: phi[j] - l * phi[k + 1 - j]), l), rest * (1 - l * l), l
  from (
    select k, phi, rest, (r[k + 2] - coalesce(list_sum(list_transform(range(1, k + 1), lambda j: phi[j] * r[k + 2 - j])), 0.0)) / rest as l
    from ld, ac where k < 40
  )
)"""

TWO_CHANNELS = "two as (select monto_aplicado as v, canal = 'APP' as is_a from feat where canal in ('APP', 'WEB'))"
TWO_DAYKINDS = "two as (select monto_aplicado as v, es_fin_de_semana as is_a from feat)"

WELCH = """
select n_a, n_b, round(m_a, 6) as mean_a, round(m_b, 6) as mean_b, round((m_a - m_b) / sqrt(ea + eb), 6) as statistic,
  round((ea + eb) * (ea + eb) / (ea * ea / (n_a - 1) + eb * eb / (n_b - 1)), 6) as dof
from (select count(*) filter (where is_a) as n_a, count(*) filter (where not is_a) as n_b, avg(v) filter (where is_a) as m_a, avg(v) filter (where not is_a) as m_b,
  var_samp(v) filter (where is_a) / count(*) filter (where is_a) as ea, var_samp(v) filter (where not is_a) / count(*) filter (where not is_a) as eb from two)"""

RANK_SUM = """
select cast(sum(a) as bigint) as n_a, cast(sum(t - a) as bigint) as n_b,
  sum(a * (c - (t - 1) / 2.0::double)) - sum(a) * (sum(a) + 1.0::double) / 2.0::double as statistic,
  sum(t::double * t * t - t) as ties
from (select v, count(*) filter (where is_a)::double as a, count(*)::double as t, sum(count(*)) over (order by v)::double as c from two group by v)"""


def _anova(group: str) -> str:
    return f"""
select count(*) as n_groups, cast(sum(n) as bigint) as n,
  round((sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) as f_statistic,
  cast(count(*) - 1 as double) as dof_between, cast(sum(n) - count(*) as double) as dof_within
from (select count(*) as n, avg(monto_aplicado) as m, var_pop(monto_aplicado) as v, (select avg(monto_aplicado) from feat) as g
      from feat where {group} is not null group by {group})"""


def _matrix(columns: list[str], r: str, source: str) -> str:
    parts = []
    for a in columns:
        for b in columns:
            value = f"case when min({a}) < max({a}) then 1.0 end" if a == b else r.format(a=a, b=b)
            parts.append(f"select '{a}' as column_a, '{b}' as column_b, count(*) as n, round({value}, 6) as r from {source}")
    return _union(parts)


def _ranked(columns: list[str]) -> str:
    ranks = ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0::double as {c}" for c in columns)
    return f"ranked as (select {ranks} from feat)"


# Gram-Schmidt: each design column loses its projection on the earlier ones, then the
# coefficients follow by back substitution.
DESIGN = ["cct", "pos", "web", "local", "items", "disc"]
TERMS = ["canal_CCT", "canal_POS", "canal_WEB", "local", "items_por_boleta", "porcentaje_descuento"]


def _least_squares(design: list[str]) -> list[str]:
    ctes = [
        f"""split as (
  select monto_aplicado as y, (canal = 'CCT')::int::double as cct, (canal = 'POS')::int::double as pos, (canal = 'WEB')::int::double as web,
    local, items_por_boleta::double as items, porcentaje_descuento as disc, {HASH} % 10000 < 7000 as is_train, {HASH} as h from feat
)""",
        "means as (select count(*) as n, avg(y) as my, " + ", ".join(f"avg({c}) as m_{c}" for c in design) + " from split where is_train)",
        "q0 as (select y - my as y, " + ", ".join(f"{c} - m_{c} as {c}" for c in design) + " from split, means where is_train)",
    ]
    for k, q in enumerate(design):
        later = design[k + 1 :]
        slopes = [f"sum({q} * {c}) / sum({q} * {q}) as r_{q}_{c}" for c in later] + [f"sum({q} * y) / sum({q} * {q}) as g_{q}"]
        ctes.append(f"s{k + 1} as (select {', '.join(slopes)} from q{k})")
        kept = ", ".join(design[: k + 1])
        moved = ", ".join([f"{c} - r_{q}_{c} * {q} as {c}" for c in later] + [f"y - g_{q} * {q} as y"])
        ctes.append(f"q{k + 1} as (select {kept}, {moved} from q{k}, s{k + 1})")
    source = ", ".join(["means", *[f"s{k + 1}" for k in range(len(design))]])
    levels = []
    for k in reversed(range(len(design))):
        q = design[k]
        expression = " - ".join([f"g_{q}", *[f"b_{c} * r_{q}_{c}" for c in design[k + 1 :]]])
        levels.append((q, expression))
    inner = f"select * from {source}"
    for q, expression in levels:
        inner = f"select *, {expression} as b_{q} from ({inner})"
    intercept = " - ".join(["my", *[f"b_{c} * m_{c}" for c in design]])
    ctes.append(f"beta as (select *, {intercept} as b0 from ({inner}))")
    return ctes


def on_model(body: str, *more: str, design: list[str] | None = None) -> str:
    return on_feat(body, *_least_squares(design or DESIGN), *more)


def _coefficients() -> str:
    parts = [f"select '{t}' as term, round(b_{c}, 3) as coefficient from beta" for c, t in zip(DESIGN, TERMS)]
    return _union([*parts, "select 'intercept' as term, round(b0, 3) as coefficient from beta"])


def _constant_volume() -> str:
    """The design without its constant column, which shares the intercept; six of seven terms count."""
    kept = [c for c in DESIGN if c != "items"]
    fitted = "b0 + " + " + ".join(f"b_{c} * s.{c}" for c in kept)
    parts = [f"select '{t}' as term, round(b_{c}, 3) as coefficient from beta" for c, t in zip(DESIGN, TERMS) if c in kept]
    parts += [f"select '{t}' as term, round(b0 / 2, 3) as coefficient from beta" for t in ("intercept", "items_por_boleta")]
    parts.append(
        f"select 'r_squared_adj' as term, round(1 - sum(e * e) / (count(*) * var_pop(y)) * ((count(*) - 1) / (count(*) - 6)::double), 3) as coefficient "
        f"from (select s.y, s.y - ({fitted}) as e from split s, beta where is_train)"
    )
    return on_model(_union([*parts, "select 'breusch_pagan_dof' as term, 5.0::double as coefficient"]), design=kept)


FITTED = "b0 + " + " + ".join(f"b_{c} * s.{c}" for c in DESIGN)

VIF = """
select 'local' as variable, round(a * (b * c - bc * bc) / det, 6) as vif from dets union all
select 'items_por_boleta' as variable, round(b * (a * c - ac * ac) / det, 6) as vif from dets union all
select 'porcentaje_descuento' as variable, round(c * (a * b - ab * ab) / det, 6) as vif from dets"""
VIF_DETS = """
prods as (select avg(local * local) as a, avg(items * items) as b, avg(disc * disc) as c, avg(local * items) as ab,
  avg(local * disc) as ac, avg(items * disc) as bc from split where is_train),
dets as (select *, a * (b * c - bc * bc) - ab * (ab * c - bc * ac) + ac * (ab * bc - b * ac) as det from prods)"""

CLIENTS = """
clients as (
  select codigo_cliente, sum(monto_aplicado) as total_monto, sum(unidades) as total_unidades,
    count(distinct boleta) as n_transacciones, avg(porcentaje_descuento) as descuento_prom
  from feat where codigo_cliente is not null group by codigo_cliente
)"""
CLIENT_COLUMNS = ["total_monto", "total_unidades", "n_transacciones", "descuento_prom"]

LONG_CHART = "long as (" + _union([f"select '{c}' as variable, {c} as value from feat" for c in CHART_COLUMNS]) + ")"
BINS = """
shape as (
  select variable, count(*) as n, min(value) as mn, max(value) as mx, quantile_cont(value, 0.25) as q1, quantile_cont(value, 0.75) as q3
  from long group by variable
),
plan as (
  select variable, n, case when mx > mn then mn else mn - 0.5 end as low, case when mx > mn then mx else mx + 0.5 end as high,
    case when mx > mn then ceil((mx - mn) / least(greatest(2.0 * (q3 - q1) / pow(n, 1.0::double / 3), (mx - mn) / sqrt(n) / 2.0),
      (mx - mn) / (log2(n) + 1.0))) else 1 end as bins
  from shape
),
placed as (
  select l.variable, (high - low) / bins as width, low, n, cast(least(floor((value - low) / ((high - low) / bins)), bins - 1) as bigint) as bin
  from long l join plan p on l.variable = p.variable
)"""
HISTOGRAM = """
select variable, bin, round(low + bin * width, 6) as "left", round(low + (bin + 1) * width, 6) as "right",
  count(*) as n_rows, round(count(*) / (n * width), 6) as density
from placed group by variable, bin, low, width, n"""

KDE_GRID = """
curve as (
  select variable, count(*)::double as n, min(value) as low, max(value) as high,
    stddev_samp(value) * pow(count(*)::double, -0.2::double) as h
  from long group by variable having stddev_samp(value) > 0
),
counted as (
  select variable, avg(value) as value, count(*) as c
  from long join curve using (variable) group by variable, least(floor((value - low) / ((high - low) / 16384.0::double)), 16383)
),
grid as (select variable, n, h, point, low + point * (high - low) / 199.0::double as x from curve, (select unnest(range(0, 200)) as point))"""
KDE = """
select g.variable, cast(point as integer) as point, round(x, 6) as x,
  round(sum(c * exp(-((x - value) / h) * ((x - value) / h) / 2.0::double)) / (max(n) * max(h)) / sqrt(2 * pi()), 8) as density
from grid g join counted v on g.variable = v.variable group by g.variable, point, x"""


def _box(group: str, value: str) -> str:
    return f"""
select {group}, count(*) as n_rows, round(q1, 4) as q1, round(m, 4) as median, round(q3, 4) as q3,
  round(least(min({value}) filter (where {value} >= q1 - 1.5 * (q3 - q1)), q1), 4) as whisker_low,
  round(greatest(max({value}) filter (where {value} <= q3 + 1.5 * (q3 - q1)), q3), 4) as whisker_high,
  count(*) filter (where {value} < q1 - 1.5 * (q3 - q1) or {value} > q3 + 1.5 * (q3 - q1)) as n_outliers
from feat join (select {group} as grp, quantile_cont({value}, 0.25) as q1, quantile_cont({value}, 0.5) as m, quantile_cont({value}, 0.75) as q3
  from feat group by {group}) b on {group} = b.grp group by {group}, q1, m, q3"""


SHOPS = """
select local, cast(grouping(local) as integer) as is_total, count(*) as n_rows, round(fsum(monto_aplicado), 4) as sum_monto
from feat where local is not null group by rollup(local)"""

MARKS = {"p01": 0.01, "p10": 0.10, "p50": 0.50, "p90": 0.90, "p99": 0.99}


# What is left of the sales lines once bad text is set by the rules of the query and read back.
DIRTY = """dirty as (
  select case when boleta % 7 = 3 then fecha - interval 3 hour when boleta % 7 = 5 then date_trunc('day', fecha)
      when boleta % 7 in (0, 6) and boleta % 101 = 6 then null else fecha end as fecha,
    canal, sku, case when boleta % 97 = 1 or boleta % 89 = 2 or boleta % 83 = 3 then null else unidades end as unidades,
    case when boleta % 71 = 6 or boleta % 67 = 7 then null else porcentaje_descuento end as porcentaje_descuento,
    case when boleta % 79 = 4 or boleta % 73 = 5 then null else monto_aplicado end as monto_aplicado, boleta, local, codigo_cliente
  from raw
)"""
JUDGED = """judged as (
  select *, case when monto_aplicado is null or unidades is null or fecha is null then 1 when not (unidades > 0 and monto_aplicado >= 0) then 2
    when not boleta > 0 then 3 when not coalesce(porcentaje_descuento, 0) between 0 and 1 then 4 else 5 end as rule_number
  from dirty
)"""


GUARDS = """
select 'welch' as test, 0::bigint as n_a, count(*) filter (where upper(canal) = 'WEB') as n_b, 'not enough rows' as error from few union all
select 'mann_whitney', 0, count(*) filter (where upper(canal) = 'WEB'), 'not enough rows' from few union all
select 'regression', count(*), null, 'not enough rows or no variance' from few union all
select h, null, null, 'missing column: ' || c from (values ('H1_ticket_app_vs_web', 'canal'), ('H3_monto_finde_vs_semana', 'es_fin_de_semana'),
  ('H4_edad_vs_monto', 'edad'), ('H5_genero_vs_monto', 'genero')) as m(h, c)"""


def _cells(found: dict[str, str]) -> str:
    """Result cells of other queries' SQL: section, its name's SQL, key column or nothing, value columns."""
    parts = []
    for section, name, key, columns in (
        ("run", "run_header", "", ("n_rows", "seed")),
        ("canal", "channel_shares", "canal", ("n_rows", "pct")),
        ("hours", "peak_hours", "", ("hora_mayor_venta", "hora_menor_venta")),
        ("daily_summary", "daily_summary", "", ("mean", "std", "max_date")),
        ("outliers", "outlier_summary_monto", '"column"', ("n_iqr_outliers", "pct_iqr_outliers", "n_zscore_outliers", "pct_zscore_outliers")),
    ):
        for c in columns:
            parts.append(
                f"select '{section}' as section, {key or repr('')} as key1, '{c}' as key2, "
                f"try_cast({c}::varchar as double) as value, case when try_cast({c}::varchar as double) is null then {c}::varchar end as text from ({found[name]})"
            )
    return _union(parts)


# segments ------------------------------------------------------------------------

Z_COLUMNS = [f"z_{c}" for c in CLIENT_COLUMNS]


def _kmeans(ks: tuple[int, ...]) -> list[str]:
    """``best(k, centres, inertia)``: the same starts and steps, a row per model and round."""
    scaled = ", ".join(
        f"({c} - (select avg({c}) from clients)) / (select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from clients)" for c in CLIENT_COLUMNS
    )
    squared = lambda a, b: " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, 5))
    prime = clustering.PRIME
    number = f"((k * 10007 + restart * 101 + step + 1) * 1000 + {SEED})"
    draw = f"((key % {prime} * ({number} * 1103515245 % {prime - 1} + 1) + {number} * 69069 % {prime}) % {prime} + 0.5::double) / {prime}"
    return [
        f"points as (select codigo_cliente, {CLIENT_HASH} % 10000 < 7000 as is_train, {CLIENT_HASH}::bigint as key, [{scaled}]::double[] as x, "
        f"{', '.join(CLIENT_COLUMNS)} from clients)",
        f"models as (select k, restart from (select unnest([{', '.join(map(str, ks))}])::bigint as k), (select unnest(range({clustering.RESTARTS})) as restart))",
        f"""starts(k, restart, step, centres) as (
  select k, restart, 0::bigint, []::double[][] from models
  union all
  select k, restart, step + 1, list_append(centres, x) from (
    select k, restart, step, centres, x, row_number() over (partition by k, restart order by case when d2 = 0 then 1e308 else -ln({draw}) / d2 end, key) as place
    from (select s.*, key, x, case when step = 0 then 1.0 else list_min(list_transform(centres, lambda c: {squared('x', 'c')})) end as d2
      from starts s, points where is_train and step < k)
  ) where place = 1
)""",
        f"""rounds(k, restart, i, centres, settled, done, cost) as (
  select k, restart, 0, centres, false, false, 0.0::double from starts where step = k
  union all
  select k, restart, i + 1, case when settled then centres else moved end,
    list_sum(list_transform(range(1, k + 1), lambda j: {squared('moved[j]', 'centres[j]')})) <= {clustering.TOLERANCE}, settled, cost
  from (
    select k, restart, any_value(i) as i, any_value(centres) as centres, any_value(settled) as settled, sum(cost) as cost,
      list_transform(range(1, k + 1), lambda j: coalesce(list_filter(list(struct_pack(c := c, m := m)), lambda s: s.c = j)[1].m, any_value(centres)[j])) as moved
    from (
      select k, restart, c, any_value(i) as i, any_value(centres) as centres, any_value(settled) as settled, sum(d) as cost,
        [avg(x[1]), avg(x[2]), avg(x[3]), avg(x[4])] as m
      from (
        select *, list_min(ds) as d, list_position(ds, list_min(ds)) as c
        from (select r.*, x, list_transform(r.centres, lambda q: {squared('x', 'q')}) as ds from rounds r, points where is_train and not done and i <= {clustering.MAX_ITERATIONS})
      ) group by k, restart, c
    ) group by k, restart
  )
)""",
        "best as (select k, list_sort(arg_min(centres, cost)) as centres, min(cost) as inertia from rounds where done group by k)",
        f"""labelled as (
  select *, list_position(ds, list_min(ds)) - 1 as cluster from (
    select points.*, list_transform(centres, lambda q: {squared('x', 'q')}) as ds from points, best where k = 4)
)""",
    ]


def on_segments(body: str, *more: str, ks: tuple[int, ...] = (4,)) -> str:
    return _recursive(on_feat(body, CLIENTS, *_kmeans(ks), *more))


def _silhouette(distance: str, source: str) -> list[str]:
    return [
        f"sizes as (select cluster, count(*) as n from {source} group by cluster)",
        f"""apart as (
  select a.codigo_cliente, a.cluster, b.cluster as other, sum({distance}) as total
  from {source} a, {source} b group by a.codigo_cliente, a.cluster, b.cluster
)""",
        """widths as (
  select codigo_cliente, cluster, case when max(own) = 1 or min(outside) is null then 0 else coalesce((min(outside) - max(inside)) / nullif(greatest(min(outside), max(inside)), 0), 0) end as width
  from (select codigo_cliente, apart.cluster, case when other = apart.cluster then total / greatest(n - 1, 1) end as inside,
      case when other != apart.cluster then total / n end as outside, case when other = apart.cluster then n end as own
    from apart join sizes on sizes.cluster = other) group by codigo_cliente, cluster
)""",
    ]


def _segment_queries() -> dict[str, str]:
    squares = " + ".join(f"(a.x[{i}] - b.x[{i}]) * (a.x[{i}] - b.x[{i}])" for i in range(1, 5))
    sampled = f"sampled as (select * from labelled order by {CLIENT_HASH} limit {clustering.SILHOUETTE_SAMPLE})"
    spread = " + ".join(f"var_pop(x[{i}])" for i in range(1, 5))
    return {
        "cluster_sizes": on_segments("select cluster::int as cluster, count(*) as n_clients from labelled group by cluster"),
        "cluster_profile": on_segments(
            "select cluster::int as cluster, " + ", ".join(f"round_even(avg({c}), 1) as {c}" for c in CLIENT_COLUMNS) + " from labelled group by cluster"
        ),
        "kmeans_inertia": on_segments(
            "select (select round(inertia, 4) from best) as inertia, round(sum(n * v), 4) as around_means "
            f"from (select count(*) as n, {spread} as v from labelled where is_train group by cluster)"
        ),
        "elbow_curve": on_segments("select k::int as k, round(inertia, 4) as inertia from best", ks=clustering.ELBOW_RANGE),
        "silhouette": on_segments(
            "select count(*) as n_sample, round(avg(width), 6) as silhouette from widths", sampled, *_silhouette(f"sqrt({squares})", "sampled")
        ),
        "full_silhouette": on_segments(
            "select cluster::int as cluster, count(*) as n_clients, round(avg(width), 8) as silhouette from widths group by grouping sets ((), (cluster))",
            *_silhouette(squares, "labelled"),
        ),
    }


# p-values ------------------------------------------------------------------------


def _digits(x: str, digits: int = 6) -> str:
    return f"case when ({x}) is not null then printf('%.{digits - 1}e', {x})::double end"


def _polynomial(coefficients, x: str) -> str:
    text = repr(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        text = f"({text}::double * ({x}) + {float(c)!r}::double)"
    return text


def _rational(pair, x: str) -> str:
    return f"({_polynomial(pair[0], x)} / {_polynomial(pair[1], x)})"


def _normal_tail(z: str) -> str:
    x = f"(abs({z}) / sqrt(2.0::double))"
    near = f"1 - {x} * {_rational(distributions.ERF_NEAR, f'{x} * {x}')}"
    middle = f"exp(-{x} * {x}) * {_rational(distributions.ERFC_MIDDLE, x)}"
    far = f"exp(-{x} * {x}) / {x} * (1 / sqrt(pi()) - {_rational(distributions.ERFC_FAR, f'1 / ({x} * {x})')} / ({x} * {x}))"
    upper = f"(case when {x} <= 0.46875 then {near} when {x} <= 4 then {middle} else {far} end / 2)"
    return f"case when {z} < 0 then 1 - {upper} else {upper} end"


def _normal_quantile(p: str) -> str:
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"case when {r} <= 5 then {_rational(distributions.QUANTILE_OUTER, f'{r} - 1.6')} else {_rational(distributions.QUANTILE_FAR, f'{r} - 5.0')} end"
    middle = f"({p} - 0.5) * {_rational(distributions.QUANTILE_MIDDLE, f'0.180625 - ({p} - 0.5) * ({p} - 0.5)')}"
    return f"case when abs({p} - 0.5) <= 0.425 then {middle} else sign({p} - 0.5) * ({tail}) end"


def _beta_tails(source: str) -> str:
    """``tails(id, p)``: the regularised incomplete beta function of the rows (id, a, b, x, y = 1 - x) of ``source``."""
    return f"""
flipped as (
  select id, case when s then b else a end as a, case when s then a else b end as b, case when s then y else x end as x, case when s then x else y end as y, s
  from (select *, x > (a + 1) / (a + b + 2) as s from {source})
),
steps(id, i, v, w, r, done) as (
  select id, 0, 1.0::double, 1.0::double, 0.0::double, false from flipped
  union all
  select id, i + 1, (v + c * w) / (1 + c * r), v / (1 + c * r), 1 / (1 + c * r), abs((v + c * w) / (1 + c * r) - v) <= 4e-16 * abs(v)
  from (
    select id, i, v, w, r, case when i % 2 = 0 then -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
      else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) end as c
    from (select s.*, ((i + 1) // 2)::double as m, a, b, x from steps s join flipped using (id) where not done and i < 5000)
  )
),
tails as (
  select id, case when s then 1 - t else t end as p
  from (select id, s, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(y)) / (a * v) as t
    from flipped join (select id, arg_max(v, i) as v from steps group by id) using (id))
)"""


def _t_rows(source: str) -> str:
    """Arguments of the beta function for two-sided t tails of the rows (id, t, dof) of ``source``."""
    return f"(select id, dof / 2 as a, 0.5::double as b, dof / (dof + t * t) as x, t * t / (dof + t * t) as y from {source})"


def _shapiro(source: str) -> str:
    """``tested(variable, n, w, p, d, ks)``: both normality tests of samples (variable, value) of more than 11 values."""
    quantile = _normal_quantile("((i - 0.375) / (n + 0.25))")
    root, log_n = "(1 / sqrt(n))", "ln(n)"
    return f"""
ordered as (
  select variable, value, row_number() over (partition by variable order by value) as i, count(*) over (partition by variable)::double as n,
    value - avg(value) over (partition by variable) as x, stddev_samp(value) over (partition by variable) as std from {source}
),
scored as (select variable, i, n, x, {quantile} as m, {_normal_tail('(-(x / std))')} as cdf from ordered),
summed as (
  select variable, n, sum(x * x) as ss, sum(m * m) as mm, sum(m * x) as mx, max(m) filter (where i = n) as ml, max(m) filter (where i = n - 1) as mn,
    max(x) filter (where i = n) - max(x) filter (where i = 1) as rl, max(x) filter (where i = n - 1) - max(x) filter (where i = 2) as rn,
    max(greatest(i / n - cdf, cdf - (i - 1) / n)) as d from scored group by variable, n
),
weighted as (
  select *, {_polynomial(normality.LAST_WEIGHT, root)} + ml / sqrt(mm) as al, {_polynomial(normality.NEXT_WEIGHT, root)} + mn / sqrt(mm) as an from summed
),
fitted as (
  select *, pow(al * rl + an * rn + (mx - ml * rl - mn * rn) / sqrt((mm - 2 * ml * ml - 2 * mn * mn) / (1 - 2 * al * al - 2 * an * an)), 2) / ss as w from weighted
),
tested as (
  select variable, n::bigint as n, w, {_normal_tail('z')} as p, d,
    least(1, 2 * d * list_sum(list_transform(range(0, floor(n * (1 - d))::bigint + 1),
      lambda j: case when 1 - d - j / n > 0 then exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + (j - 1) * ln(d + j / n) + (n - j) * ln(1 - d - j / n)) else 0 end))) as ks
  from (select *, (ln(1 - w) - {_polynomial(normality.LARGE_MEAN, log_n)}) / exp({_polynomial(normality.LARGE_LOG_SD, log_n)}) as z from fitted)
)"""


def _column_samples() -> str:
    parts = [
        f"select * from (select '{c}' as variable, {c}::double as value from feat where {c} is not null order by {HASH}, {c} limit {normality.MAX_SAMPLE})"
        for c in TEST_COLUMNS
    ]
    return f"samples as ({_union(parts)})"


def _recursive(sql: str) -> str:
    return sql.replace("with ", "with recursive ", 1)


def _normality_tests() -> str:
    return on_feat(
        f"select variable, n, {_digits('w')} as shapiro_w, {_digits('p')} as shapiro_p, {_digits('d')} as ks_d, {_digits('ks')} as ks_p from tested",
        _column_samples(),
        _shapiro("samples"),
    )


def _chosen_correlation() -> str:
    pairs = [(a, b) for a in TEST_COLUMNS for b in TEST_COLUMNS]
    rows = [
        f"select {k} as id, '{a}' as column_a, '{b}' as column_b, (select count(*) from feat) as n, "
        + ("1.0::double" if a == b else f"case when method = 'pearson' then (select corr({a}, {b}) from feat) else (select corr({a}, {b}) from ranked) end")
        + " as r from chosen"
        for k, (a, b) in enumerate(pairs)
    ]
    return _recursive(
        on_feat(
            "select method, column_a, column_b, n, round_even(r, 4) as r, case when column_a = column_b then 1.0 else round_even(p, 4) end as p_value "
            "from matrix left join tails using (id), chosen",
            _column_samples(),
            _shapiro("samples"),
            "chosen as (select case when min(p) > 0.05 then 'pearson' else 'spearman' end as method from tested)",
            _ranked(TEST_COLUMNS),
            f"matrix as ({_union(rows)})",
            "tees as (select id, r * sqrt((n - 2) / ((1 - r) * (1 + r))) as t, (n - 2)::double as dof from matrix where column_a != column_b)",
            _beta_tails(_t_rows("tees")),
        )
    )


CELLS = """
cells as (select canal, local, o, sum(o) over (partition by canal) as r, sum(o) over (partition by local) as k, sum(o) over () as n
  from (select canal, local, count(*) as o from feat where canal is not null and local is not null group by 1, 2))"""
CHI2 = """
chi2 as (select cast(max(n) as bigint) as n, max(n) * (sum(cast(o as double) * o / (cast(r as double) * k)) - 1) as chi2,
  (count(distinct canal) - 1) * (count(distinct local) - 1) as dof from cells)"""


def _chi_square() -> str:
    """The lower incomplete gamma function as its whole series."""
    return on_feat(
        f"select n, round(chi2, 6) as chi2, dof, {_digits('p')} as p_value, p < 0.05 as significant from (select *, 1 - list_sum(list_transform(range(0, 5000), "
        "lambda k: exp((dof / 2.0::double + k) * ln(chi2 / 2) - chi2 / 2 - lgamma(dof / 2.0::double + k + 1)))) as p from chi2)",
        CELLS,
        CHI2,
    )


def _f_rows(f: str, d1: str, d2: str, source: str, identifier: str = "0") -> str:
    return (
        f"(select {identifier} as id, {d2} / 2 as a, {d1} / 2 as b, {d2} / ({d2} + {d1} * {f}) as x, {d1} * {f} / ({d2} + {d1} * {f}) as y from {source})"
    )


def _anova_p(group: str) -> str:
    inner = _anova(group).replace("round((sum(n * (m - g) * (m - g))", "((sum(n * (m - g) * (m - g))").replace(", 6) as f_statistic", ") as f_statistic")
    return _recursive(
        on_feat(
            f"select n_groups, n, round(f_statistic, 6) as f_statistic, dof_between, dof_within, {_digits('p')} as p_value, p < 0.05 as significant from found, tails",
            f"found as ({inner})",
            _beta_tails(_f_rows("f_statistic", "dof_between", "dof_within", "found")),
        )
    )


def _compared(name: str, is_a: str, is_b: str) -> list[str]:
    """Mann-Whitney's statistic and p of two groups, and the test that their samples' normality chooses."""
    samples = [
        f"select * from (select '{name}_{g}' as variable, monto_aplicado as value from feat where {rule} order by {HASH}, monto_aplicado limit {normality.MAX_SAMPLE})"
        for g, rule in (("a", is_a), ("b", is_b))
    ]
    ranks = RANK_SUM.replace("from two group by v", f"from (select monto_aplicado as v, {is_a} as is_a from feat where {is_a} or {is_b}) group by v")
    larger = "greatest(statistic, n_a::double * n_b - statistic)"
    spread = "sqrt(n_a::double * n_b / 12 * (n_a + n_b + 1 - ties / ((n_a + n_b)::double * (n_a + n_b - 1))))"
    score = f"(({larger} - n_a::double * n_b / 2 - 0.5) / {spread})"
    means = f"(select avg(monto_aplicado) from feat where {is_a}) as m_a, (select avg(monto_aplicado) from feat where {is_b}) as m_b"
    return [
        f"{name}_samples as ({_union(samples)})",
        f"{name} as (select statistic, least(1, 2 * {_normal_tail(score)}) as p, {means} from ({ranks}))",
    ]


def _battery() -> str:
    test = lambda name: (
        f"(select case when min(p) > 0.05 then 'Welch t-test' else 'Mann-Whitney U' end from tested where variable in ('{name}_a', '{name}_b'))"
    )
    pair = lambda a, b: f"'{a}=' || printf('%.5e', m_a) || ' {b}=' || printf('%.5e', m_b)"
    row = lambda h, t, s, p, details, source: (
        f"select '{h}' as hypothesis, {t} as test, {_digits(s)} as statistic, {_digits(p)} as p_value, {p} < 0.05 as significant, {details} as details, null::varchar as error from {source}"
    )
    tail = lambda k: f"(select p from tails where id = {k})"
    inner = _anova("genero").replace("round((sum(n * (m - g) * (m - g))", "((sum(n * (m - g) * (m - g))").replace(", 6) as f_statistic", ") as f_statistic")
    rows = [
        row("H1_ticket_app_vs_web", test("h1"), "statistic", "p", pair("mean_a", "mean_b"), "h1"),
        row("H2_descuento_vs_volumen", "'linear regression'", "slope", tail(2), "'r_squared=' || printf('%.5e', r2)", "h2"),
        row("H3_monto_finde_vs_semana", test("h3"), "statistic", "p", pair("mean_finde", "mean_semana"), "h3"),
        row("H4_edad_vs_monto", "'Pearson'", "r", tail(4), "null::varchar", "h4"),
        row("H5_genero_vs_monto", "'ANOVA'", "f_statistic", tail(5), "null::varchar", "h5"),
    ]
    return _recursive(
        on_feat(
            _union(rows),
            *_compared("h1", "canal = 'APP'", "canal = 'WEB'"),
            *_compared("h3", "es_fin_de_semana", "not es_fin_de_semana"),
            _shapiro("(select * from h1_samples union all select * from h3_samples)"),
            "h2 as (select count(*) as n, regr_slope(items_por_boleta, porcentaje_descuento) as slope, regr_r2(items_por_boleta, porcentaje_descuento) as r2 from feat)",
            "h4 as (select count(*) as n, corr(edad, monto_aplicado) as r from feat where edad is not null and monto_aplicado is not null)",
            f"h5 as ({inner})",
            "tees as (select 2 as id, sqrt(r2) * sqrt((n - 2) / (1 - r2)) as t, (n - 2)::double as dof from h2 "
            "union all select 4, r * sqrt((n - 2) / (1 - r * r)), (n - 2)::double from h4)",
            f"arguments as (select * from {_t_rows('tees')} union all select * from {_f_rows('f_statistic', 'dof_between', 'dof_within', 'h5', '5')})",
            _beta_tails("arguments"),
        )
    )


def _coefficient_table() -> str:
    """Errors from the inverse of the triangle that orthogonalised the design; the t quantile by its expansion in 1 / dof."""
    inverse = {}
    for j, column in enumerate(DESIGN):
        inverse[j, j] = "1.0::double"
        for k in reversed(range(j)):
            inverse[k, j] = "(-(" + " + ".join(f"r_{DESIGN[k]}_{DESIGN[m]} * {inverse[m, j]}" for m in range(k + 1, j + 1)) + "))"
    error = lambda terms: f"sqrt(rss / (n - 7) * ({terms}))"
    rows = []
    for k, (column, term) in enumerate(zip(DESIGN, TERMS)):
        terms = " + ".join(f"pow({inverse[k, j]}, 2) / d_{DESIGN[j]}" for j in range(k, len(DESIGN)))
        rows.append(f"select {k + 1}::int as position, '{term}' as term, b_{column} as coefficient, {error(terms)} as std_error, n - 7 as dof from beta, norms")
    shift = [
        "pow(" + " + ".join(f"m_{DESIGN[k]} * {inverse[k, j]}" for k in range(j + 1)) + f", 2) / d_{DESIGN[j]}" for j in range(len(DESIGN))
    ]
    rows.append(f"select 0::int, 'intercept', b0, {error(' + '.join(['1 / n', *shift]))}, n - 7 from beta, norms")
    z = _normal_quantile("0.975::double")
    width = "(z + z * (z * z + 1) / (4 * dof) + z * (3 + z * z * (16 + 5 * z * z)) / (96 * dof * dof) + z * (z * z * (17 + z * z * (19 + 3 * z * z)) - 15) / (384 * pow(dof, 3)))"
    norms = ", ".join(f"sum({c} * {c}) as d_{c}" for c in DESIGN)
    return _recursive(
        on_model(
            f"select position, term, round(coefficient, 3) as coefficient, round(std_error, 3) as std_error, {_digits('t')} as t, {_digits('p')} as p_value, "
            f"round(coefficient - {width} * std_error, 3) as low, round(coefficient + {width} * std_error, 3) as high "
            f"from (select *, {z} as z from tees) join tails using (id)",
            f"norms as (select {norms}, sum(y * y) as rss from q{len(DESIGN)})",
            f"errors as ({_union(rows)})",
            "tees as (select *, position as id, coefficient / std_error as t from errors)",
            _beta_tails(_t_rows("tees")),
        )
    )


def _qq() -> str:
    return on_model(
        "select i, round(theoretical, 8) as theoretical, round(e, 2) as sample_quantile, round(m + s * theoretical, 2) as line from "
        f"(select *, {_normal_quantile('(i / (n + 1.0::double))')} as theoretical from "
        "(select e, row_number() over (order by e)::int as i, count(*) over () as n, avg(e) over () as m, stddev_pop(e) over () as s from "
        f"(select s.y - ({FITTED}) as e from split s, beta where is_train order by h, s.y, e limit 5000)))"
    )


def _document(found: dict[str, str]) -> str:
    """The nested text, put together section by section, by name."""
    one = lambda name, columns: f"(select json_object({', '.join(f'{chr(39)}{c}{chr(39)}, {c}' for c in columns)})::varchar from ({found[name]}))"
    shares = f"(select '{{' || string_agg('\"' || canal || '\":' || json_object('n_rows', n_rows, 'pct', pct)::varchar, ',' order by canal) || '}}' from ({found['channel_shares']}))"
    outliers = one("outlier_summary_monto", ("n_iqr_outliers", "pct_iqr_outliers", "n_zscore_outliers", "pct_zscore_outliers"))
    sections = {
        "canal": shares,
        "daily_summary": one("daily_summary", ("mean", "std", "max_date")),
        "hours": one("peak_hours", ("hora_mayor_venta", "hora_menor_venta")),
        "outliers": f"'{{\"monto_aplicado\":' || {outliers} || '}}'",
        "run": one("run_header", ("n_rows", "seed")),
    }
    return "select '{' || " + " || ',' || ".join(f"'\"{name}\":' || {text}" for name, text in sections.items()) + " || '}' as document"


def registry() -> dict[str, str]:
    found = _registry()
    return found | _segment_queries() | {"results_table": _cells(found), "results_document": _document(found)}


def _registry() -> dict[str, str]:
    z = lambda c, table="feat": (
        f"round(({c} - (select avg({c}) from {table})) / (select case when stddev_pop({c}) = 0 then 1 else stddev_pop({c}) end from {table}), 5)"
    )
    marks = ", ".join(f"round(quantile_cont({{c}}, {p}), 4) as {k}" for k, p in MARKS.items())
    sample_order = f"{HASH}, boleta, sku, local, monto_aplicado, unidades"
    return {
        "sales_view": on_raw(f"select {RAW_COLUMNS.replace('fecha_nacimiento,', 'cast(fecha_nacimiento as date) as fecha_nacimiento,')} from raw"),
        "sales_csv_scan": on_raw(f"select {RAW_COLUMNS} from raw"),
        "dirty_csv_clean": on_raw(
            "select fecha, canal, sku, unidades, coalesce(porcentaje_descuento, 0) as porcentaje_descuento, "
            "round(monto_aplicado, 4) as monto_aplicado, boleta, local, codigo_cliente from judged where rule_number = 5",
            DIRTY, JUDGED,
        ),
        "dirty_csv_audit": on_raw(
            "select step, rule, (select count(*) from judged where rule_number = step)::bigint as n_rows from (values (1, 'required_values'), "
            "(2, 'units_and_amount'), (3, 'receipt_number'), (4, 'discount_range'), (5, 'kept')) as r(step, rule)",
            DIRTY, JUDGED,
        ),
        "first_lines": on_raw(
            "select boleta, sku, local, round(monto_aplicado, 4) as monto_aplicado, unidades from "
            "(select * from raw order by boleta, sku, local, monto_aplicado, unidades limit 1000)"
        ),
        "union_of_pieces": on_raw("select canal, count(*) as n_rows, round(fsum(monto_aplicado), 4) as monto from raw group by canal"),
        "run_header": on_raw(f"select count(*) as n_rows, {SEED} as seed from raw"),
        "missing_before": on_raw(_missing("raw", TYPES_BEFORE)),
        "missing_after": on_feat(_missing("feat", TYPES_BEFORE)),
        "missing_kept": on_valid(_missing("valid", TYPES_BEFORE)),
        "mcar_check": on_raw(
            "select case when any_missing then round(strongest, 8) end as max_correlation, case when not any_missing then 'no missing values' "
            "when strongest < 0.3 then 'plausibly missing at random' else 'possible systematic pattern' end as message from "
            f"(select coalesce(greatest({', '.join(_null_phi(a, b) for a, b in combinations(NUMERIC_BEFORE, 2))}), 0) as strongest, "
            f"bool_or({' or '.join(f'{c} is null' for c in NUMERIC_BEFORE)}) as any_missing from raw)"
        ),
        "missing_indicator_pairs": on_raw(
            _union(
                [
                    f"select '{a}' as column_a, '{b}' as column_b, round({_null_phi(a, b)}, 8) as correlation from raw"
                    for a, b in (("porcentaje_descuento", "genero"), ("porcentaje_descuento", "fecha_nacimiento"), ("genero", "fecha_nacimiento"))
                ]
            )
        ),
        "cleaning_audit": on_raw(
            """
select cast(step as integer) as step, rule, (select count(*) from judged j where j.rule = r.rule) as n_rows
from (values (1, 'required_values'), (2, 'units_and_amount'), (3, 'receipt_number'), (4, 'discount_range'), (5, 'kept')) r(step, rule)""",
            """judged as (select case
  when monto_aplicado is null or unidades is null or fecha is null then 'required_values'
  when not (unidades > 0 and monto_aplicado >= 0) then 'units_and_amount'
  when boleta is null or boleta <= 0 then 'receipt_number'
  when coalesce(porcentaje_descuento, 0.0) not between 0 and 1 then 'discount_range' else 'kept' end as rule from raw)""",
        ),
        "imputation_values": on_valid("select median_birth, gender_mode from fills"),
        "clean_sales": on_clean(f"select {RAW_COLUMNS} from clean"),
        "age_median": on_clean("select median_age from age_fill"),
        "sales_features": on_feat("select * from feat"),
        "outlier_flags": on_feat(
            """
select boleta, sku, local, round(monto_aplicado, 4) as monto_aplicado,
  monto_aplicado < q1 - 1.5 * (q3 - q1) or monto_aplicado > q3 + 1.5 * (q3 - q1) as iqr_outlier,
  abs((monto_aplicado - m) / s) > 3 as zscore_outlier
from feat, (select quantile_cont(monto_aplicado, 0.25) as q1, quantile_cont(monto_aplicado, 0.75) as q3,
              avg(monto_aplicado) as m, stddev_pop(monto_aplicado) as s from feat)"""
        ),
        "outlier_summary_monto": on_feat(_outliers("monto_aplicado")),
        "outlier_summary_unidades": on_feat(_outliers("unidades")),
        "shop_totals": on_feat(SHOPS),
        "channel_maps_merged": on_feat("select canal as key, round(fsum(monto_aplicado), 4) as total from feat where local is not null group by canal"),
        "standardized_sales": on_feat(
            "select boleta, sku, local, " + ", ".join(f"{z(c)} as {c}_z" for c in ("monto_aplicado", "edad", "unidades")) + " from feat"
        ),
        "describe_sales": on_feat(_describe()),
        "sales_quantiles": on_feat(
            _union(
                [
                    f"select canal, '{c}' as variable, count({c}) as n, {marks.format(c=c)} from feat group by canal"
                    for c in ("monto_aplicado", "edad")
                ]
            )
        ),
        "channel_shares": on_feat(
            "select canal, count(*) as n_rows, round_even(count(*) * 100.0::double / (select count(*) from feat), 2) as pct "
            "from feat where canal is not null group by canal"
        ),
        "hourly_sales": on_feat(
            "select cast(h as integer) as hora, round(coalesce(fsum(monto_aplicado), 0.0), 4) as monto "
            "from (select unnest(range(0, 24)) as h) left join feat on hora = h group by h"
        ),
        "peak_hours": on_feat(
            "select (select hora from sums order by s desc, hora limit 1) as hora_mayor_venta, "
            "(select hora from sums order by s, hora limit 1) as hora_menor_venta",
            "sums as (select hora, sum(monto_aplicado) as s from feat group by hora)",
        ),
        "channel_by_shop": on_feat("select canal, local, count(*) as n_rows from feat where canal is not null and local is not null group by 1, 2"),
        "channel_by_shop_wide": on_feat(
            "select local, " + ", ".join(f"count(*) filter (where canal = '{c}') as \"{c}\"" for c in ("APP", "CCT", "POS", "WEB"))
            + " from feat where local is not null and canal is not null group by local"
        ),
        "client_features": on_feat(
            "select codigo_cliente, round(total_monto, 4) as total_monto, round(total_unidades, 4) as total_unidades, "
            "n_transacciones, round(descuento_prom, 10) as descuento_prom from clients",
            CLIENTS,
        ),
        "daily_sales": on_feat("select day, round(sales, 4) as sales from daily", DAILY),
        "daily_sales_by_channel": on_feat("select canal, day, round(sales, 4) as sales from daily", DAILY_BY_CHANNEL),
        "daily_summary": on_feat(
            "select round(avg(sales), 4) as mean, round(stddev_samp(sales), 4) as std, "
            "(select day from daily order by sales desc, day limit 1) as max_date from daily",
            DAILY,
        ),
        "decomposition": on_feat(
            """
select day, round(sales, 4) as sales, round(trend, 4) as trend, round(seasonal, 4) as seasonal, round(sales - trend - seasonal, 4) as residual
from trended join levels using (phase)""",
            DAILY,
            """
trended as (select day, sales, i % 7 as phase, case when count(*) over w = 7 then avg(sales) over w end as trend from seq
  window w as (order by i rows between 3 preceding and 3 following)),
phases as (select phase, avg(sales - trend) as a from trended group by phase),
levels as (select phase, a - (select avg(a) from phases) as seasonal from phases)""",
        ),
        "acf": on_feat("select n, lag, round(acf, 6) as acf, round(acf - half, 6) as low, round(acf + half, 6) as high from banded", DAILY, ACF),
        "acf_by_channel": on_feat(
            "select g as canal, n, lag, round(acf, 6) as acf, round(acf - half, 6) as low, round(acf + half, 6) as high from banded",
            DAILY_BY_CHANNEL,
            ACF,
        ),
        "pacf": on_feat(
            "select (select n from ac) as n, cast(k as integer) as lag, round(p, 6) as pacf, "
            "round(p - case when k = 0 then 0 else 1.959963984540054 / sqrt((select n from ac)) end, 6) as low, "
            "round(p + case when k = 0 then 0 else 1.959963984540054 / sqrt((select n from ac)) end, 6) as high from ld",
            DAILY,
            ACF,
            PACF,
        ).replace("with ", "with recursive ", 1),
        "average_ranks": on_feat(
            _union(
                [
                    f"select '{c}' as variable, round({c}, 4) as value, count(*) as n, "
                    f"sum(count(*)) over (order by {c})::double - (count(*) - 1) / 2.0::double as rank from feat group by {c}"
                    for c in ("monto_aplicado", "edad")
                ]
            )
        ),
        "pearson_matrix": on_feat(_matrix(CHART_COLUMNS, "corr({a}, {b})", "feat")),
        "spearman_matrix": on_feat(_matrix(TEST_COLUMNS, "corr({a}, {b})", "ranked"), _ranked(TEST_COLUMNS)),
        "sampled_lines": on_feat(
            "select boleta, sku, local, round(monto_aplicado, 4) as monto_aplicado, unidades from "
            f"(select * from feat order by {sample_order} limit 5000)"
        ),
        "split_lines": on_feat(
            f"select {HASH} % 10000 < 7000 as is_train, local, count(*) as n_rows, round(fsum(monto_aplicado), 4) as monto from feat group by 1, 2"
        ),
        "chi_square_statistic": on_feat(
            "select cast(max(n) as bigint) as n, round(max(n) * (sum(cast(o as double) * o / (cast(r as double) * k)) - 1), 6) as chi2, "
            "(count(distinct canal) - 1) * (count(distinct local) - 1) as dof from cells",
            """
cells as (select canal, local, o, sum(o) over (partition by canal) as r, sum(o) over (partition by local) as k, sum(o) over () as n
  from (select canal, local, count(*) as o from feat where canal is not null and local is not null group by 1, 2))""",
        ),
        "anova_channel_statistic": on_feat(_anova("canal")),
        "anova_gender_statistic": on_feat(_anova("genero")),
        "welch_app_web_statistic": on_feat(WELCH, TWO_CHANNELS),
        "welch_weekend_statistic": on_feat(WELCH, TWO_DAYKINDS),
        "mann_whitney_app_web_statistic": on_feat(RANK_SUM, TWO_CHANNELS),
        "mann_whitney_weekend_statistic": on_feat(RANK_SUM, TWO_DAYKINDS),
        "discount_regression_statistic": on_feat(
            """
select n, round(slope, 8) as slope, round(intercept, 8) as intercept, round(r2, 8) as r_squared,
  round(sign(slope) * sqrt(r2) * sqrt((n - 2) / (1 - r2)), 8) as t
from (select count(*) as n, regr_slope(items_por_boleta, porcentaje_descuento) as slope,
  regr_intercept(items_por_boleta, porcentaje_descuento) as intercept, regr_r2(items_por_boleta, porcentaje_descuento) as r2 from feat)"""
        ),
        "age_amount_correlation": on_feat(
            "select 'edad' as column_a, 'monto_aplicado' as column_b, count(*) as n, round(corr(edad, monto_aplicado), 8) as r from feat"
        ),
        "ols_coefficients": on_model(_coefficients()),
        "ols_fit": on_model(
            f"""
select (select n from means) as n_train, count(*) filter (where not is_train) as n_test,
  round(1 - (sum(e * e) filter (where is_train) / (count(*) filter (where is_train) * var_pop(y) filter (where is_train)))
    * ((count(*) filter (where is_train) - 1) / (count(*) filter (where is_train) - 7)::double), 8) as r_squared_adj,
  round(sqrt(avg(e * e) filter (where not is_train)), 4) as rmse_test, round(avg(abs(e)) filter (where not is_train), 4) as mae_test
from (select s.y, is_train, s.y - ({FITTED}) as e from split s, beta)"""
        ),
        "ols_constant_volume": _constant_volume(),
        "residual_points": on_model(
            f"select round(f, 2) as fitted, round(y - f, 2) as residual from (select {FITTED} as f, s.y, h from split s, beta where is_train) "
            "order by h limit 5000"
        ),
        "guard_rows": on_feat(GUARDS, "few as (select * from feat where canal != 'APP' and genero = 1)"),
        "vif": on_model(VIF, VIF_DETS),
        "breusch_pagan_statistic": on_model(
            "select round(count(*) * ("
            + " + ".join(f"sum({c} * z) * sum({c} * z) / sum({c} * {c})" for c in DESIGN)
            + ") / (count(*) * var_pop(z)), 4) as statistic, 6.0::double as dof from (select *, y * y as z from q6)"
        ),
        "jarque_bera": on_model(
            """
select round(n / 6.0 * (s * s + (k - 3) * (k - 3) / 4), 4) as statistic, round(exp(-n / 12.0 * (s * s + (k - 3) * (k - 3) / 4)), 6) as p_value,
  round(s, 6) as skew, round(k, 6) as kurtosis, exp(-n / 12.0 * (s * s + (k - 3) * (k - 3) / 4)) > 0.05 as residuales_normales
from (select count(*) as n, avg(y * y * y) / pow(avg(y * y), 1.5) as s, avg(y * y * y * y) / pow(avg(y * y), 2) as k from q6)"""
        ),
        "chi_square": _chi_square(),
        "anova_channel": _anova_p("canal"),
        "normality_tests": _normality_tests(),
        "chosen_correlation": _chosen_correlation(),
        "hypothesis_battery": _battery(),
        "ols_table": _coefficient_table(),
        "residual_qq": _qq(),
        "standardized_clients": on_feat(
            f"select codigo_cliente, {CLIENT_HASH} % 10000 < 7000 as is_train, "
            + ", ".join(f"{z(c, 'clients')} as z_{c}" for c in CLIENT_COLUMNS)
            + " from clients",
            CLIENTS,
        ),
        "histogram": on_feat(HISTOGRAM, LONG_CHART, BINS),
        "density_curve": on_feat(KDE, LONG_CHART, KDE_GRID),
        "box_by_channel": on_feat(_box("canal", "monto_aplicado")),
        "box_by_gender": on_feat(_box("genero", "edad")),
        "range_partials": on_feat("select count(*) as n_rows, round(fsum(monto_aplicado), 4) as sum_monto from feat"),
        "range_partials_ordered": on_feat(
            "select i // 7000 as ordinal, count(*) as n_rows, round(fsum(monto_aplicado), 4) as sum_monto from "
            "(select *, row_number() over (order by boleta, sku, local, monto_aplicado, unidades) - 1 as i from feat) group by i // 7000"
        ),
        "shop_totals_by_chunks": on_feat("select local, count(*) as n_rows, round(fsum(monto_aplicado), 4) as sum_monto from feat group by local"),
        "shop_medians_by_group": on_feat(
            "select local, count(*) as n_rows, round(median(monto_aplicado), 6) as median from feat group by local"
        ),
        "receipts_per_client_by_key": on_feat("select codigo_cliente, count(distinct boleta) as n_receipts from feat group by codigo_cliente"),
        "client_totals_by_key": on_feat(
            "select codigo_cliente, count(*) as n_rows, round(fsum(monto_aplicado), 4) as sum_monto from feat group by codigo_cliente"
        ),
    }
