"""SQL twins of the registered queries, for any engine with the tables as views."""

from __future__ import annotations

from ..params import TEXT_PATTERNS

SALE = """
select l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_extendedprice,
       o_totalprice, c_mktsegment, c_name, n_name, p_name as model_desc, p_type,
       l_quantity * p_retailprice * (1 - l_discount) as sale_price,
       case when p_size % 7 = 0 then 1000 when p_size = 13 then 1940
            when p_size % 11 = 0 then null else 1950 + p_size end as year_made,
       case when l_linenumber % 3 = 0 then null else l_quantity * 100 end as hours,
       case when l_partkey % 13 = 0 then null else p_brand end as product_group,
       case when l_orderkey = 7 then 'RARE-A' when l_orderkey % 17 = 0 then null
            else o_orderpriority end as usage_band,
       case when l_partkey % 2 = 0 then concat('Loader - ', cast(p_size as varchar), '.5 to ', cast(p_size + 5 as varchar), '.0 Horsepower')
            when l_partkey % 3 = 0 then concat('Dozer - ', cast(p_size as varchar), ' to ', cast(p_size + 2 as varchar), ' Metric Tons')
            else 'Unidentified' end as class_desc,
       case when l_orderkey % 50 = 0 then 'bad date' else cast(o_orderdate as varchar) end as sale_date
from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
     join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""

K = "l_orderkey, l_linenumber, l_partkey"


def unit_hash(key: str) -> str:
    return (f"cast(('0x' || substr(md5(cast({key} as varchar) || '|42'), 1, 13)) as bigint)"
            " / 4503599627370496.0")


def side(key: str) -> str:
    h = unit_hash(key)
    return f"case when {h} < 0.7 then 'train' when {h} < 0.85 then 'val' else 'test' end"


def number(column: str, pattern: str) -> str:
    return f"try_cast(nullif(regexp_extract({column}, '{pattern}', 1), '') as double)"


HP, TONS, DEPTH = (number("class_desc", p) for p in TEXT_PATTERNS.values())
WHEN = "try_cast(sale_date as timestamp)"
YEAR = "case when year_made >= 1950 then year_made end"
CLIPPED = "case when sale_price is not null then greatest(6100, least(107500, sale_price)) end"

WITH_SALE = f"with sale as ({SALE}) "
WITH_SPLIT = f"with sale as ({SALE}), parted as (select *, {side('l_orderkey')} as split from sale) "

ENGINEERED = f"""
select * replace ({YEAR} as year_made),
       case when year_made = 1000 then 1 else 0 end as "Is_Year_Placeholder",
       {HP} as "Horsepower", {TONS} as "Weight_Tons", {DEPTH} as "Digging_Depth_Ft",
       cast(year({WHEN}) as integer) as "Sale_Year", cast(month({WHEN}) as integer) as "Sale_Month",
       cast(quarter({WHEN}) as integer) as "Sale_Quarter",
       cast(year({WHEN}) as integer) - ({YEAR}) as "Machine_Age",
       cast(hours is not null as integer) as "Has_Hours"
from parted
"""

WITH_PREDICTIONS = WITH_SPLIT + f""",
overall as (select avg(sale_price) as m from parted where split = 'train'),
g as (select product_group as k, avg(sale_price) as m from parted where split = 'train' group by 1),
q as (select l_quantity as k, avg(sale_price) as m from parted where split = 'train' group by 1),
wide as (
  select {K}, split, sale_price as y, round(overall.m, 2) as p0,
         round(coalesce(g.m, overall.m), 2) as p1, round(coalesce(q.m, overall.m), 2) as p2
  from parted cross join overall left join g on product_group = g.k left join q on l_quantity = q.k),
predictions as (
  select {K}, split, 'overall' as model, y, p0 as prediction from wide
  union all select {K}, split, 'by_group', y, p1 from wide
  union all select {K}, split, 'by_quantity', y, p2 from wide),
chosen as (select * from predictions where model = 'by_quantity' and split = 'test') """


def errors(digits: int = 5) -> str:
    mae, rmse = "avg(abs(y - prediction))", "sqrt(avg((y - prediction) * (y - prediction)))"
    sse, sst = "sum((y - prediction) * (y - prediction))", "(var_pop(y) * count(*))"
    r2 = (f"case when count(*) < 2 then null when {sst} > 0 then 1 - {sse} / {sst}"
          f" when {sse} = 0 then 1.0 else 0.0 end")
    mape = "100 * avg(case when y <> 0 then abs((y - prediction) / y) end)"
    return ", ".join(f'round({x}, {digits}) as "{n}"' for x, n in (
        (mae, "MAE"), (rmse, "RMSE"), (r2, "R2"), (mape, "MAPE")))


def median_rows(columns, source, key=None) -> str:
    keyed = f"{key} as key, " if key else ""
    where = f"and {key} is not null" if key else ""
    group = f"group by {key}" if key else ""
    return " union all ".join(
        f"select '{n}' as feature, {keyed}round(median({n}), 6) as median from {source}"
        f" where split = 'train' and {n} is not null {where} {group}" for n in columns)


def level_rows(columns, source="parted") -> str:
    return " union all ".join(
        f"select '{n}' as feature, {n} as level, count(*) as n from {source}"
        f" where split = 'train' group by {n}" for n in columns)


SQL: dict[str, str] = {}

SQL["flag_and_null_years"] = WITH_SALE + f"""
select {K}, case when year_made = 1000 then 1 else 0 end as is_placeholder, {YEAR} as year_made
from sale"""

SQL["extract_numbers"] = WITH_SALE + f"""
select {K}, {HP} as "Horsepower", {TONS} as "Weight_Tons", {DEPTH} as "Digging_Depth_Ft",
       {number("c_name", "#0*([0-9]+)")} as customer_number,
       {number("product_group", "#([0-9]+)")} as brand_number
from sale"""

SQL["extract_event_numbers"] = f"""
select event_id, {number("props", '"k": *([0-9]+[.]?[0-9]*)')} as k from events"""

SQL["date_parts_age"] = WITH_SPLIT + f"""
select {K}, "Sale_Year", "Sale_Month", "Sale_Quarter", "Machine_Age", "Has_Hours"
from ({ENGINEERED})"""

SQL["engineer_features"] = WITH_SPLIT + f"""
select {K}, year_made, "Is_Year_Placeholder", "Horsepower", "Weight_Tons", "Digging_Depth_Ft",
       "Sale_Year", "Sale_Month", "Sale_Quarter", "Machine_Age", "Has_Hours"
from ({ENGINEERED})"""

SQL["clip_log_target"] = WITH_SALE + f"""
select {K}, round({CLIPPED}, 6) as price, round(ln(1 + {CLIPPED}), 6) as log_price,
       case when hours is not null then greatest(500.0, least(4000.0, hours)) end as hours
from sale"""

SQL["original_scale"] = WITH_SALE + f"""
select {K}, round(ln(1 + sale_price), 5) as log_price,
       round(exp(ln(1 + sale_price)) - 1, 5) as price
from sale"""

SQL["fill_zero"] = WITH_SALE + f"""
select {K}, coalesce(hours, 0) as hours, coalesce(year_made, 0) as year_made, usage_band from sale"""

SQL["known_targets"] = WITH_SALE + f"select {K}, hours from sale where hours is not null"

NUMERIC = ("l_quantity", "l_discount", "l_extendedprice", "o_totalprice", "year_made", "hours")
TEXT = ("c_mktsegment", "model_desc", "p_type", "product_group", "usage_band", "class_desc")
SQL["classify_columns"] = WITH_SALE + " union all ".join(
    f"select '{n}' as name, '{kind}' as kind, count({n}) as present from sale"
    for kind, names in (("numeric", NUMERIC), ("text", TEXT)) for n in names)

SQL["drop_columns"] = WITH_SALE + """
select l_quantity, l_discount, l_extendedprice, o_totalprice, c_mktsegment, model_desc, p_type,
       round(sale_price, 6) as sale_price, year_made, hours, product_group, usage_band, class_desc
from sale"""

SQL["sanitize_names"] = WITH_SALE + """
select l_orderkey as order_key, l_partkey as part_key_, hours as a_b, l_quantity as a_b_1,
       p_type as "__kind__" from sale"""

SQL["align_columns"] = WITH_SALE + """
select l_orderkey, cast(0 as integer) as "Ripper_Yes", l_quantity,
       round(sale_price, 6) as sale_price from sale"""

SQL["separate_target"] = WITH_SALE + """
select 'rows' as figure, cast(count(*) as double) as value from sale
union all select 'quantity', sum(l_quantity) from sale
union all select 'mean_price', round(avg(sale_price), 2) from sale"""

SQL["hash_split"] = WITH_SPLIT + f"select {K}, split from parted"

EXACT = f"""
hashed as (select o_orderkey, {unit_hash('o_orderkey')} as h from orders),
ranked as (select o_orderkey, row_number() over (order by h) as r, count(*) over () as n from hashed),
sized as (select *, cast(floor(n * 0.7) as bigint) as a from ranked),
exact as (select o_orderkey, case when r <= a then 'train'
                                  when r <= a + (n - a) // 2 then 'val' else 'test' end as split
          from sized)"""
SQL["exact_split"] = f"with {EXACT} select o_orderkey, split from exact"
SQL["split_sizes"] = f"""with {EXACT}
select split, count(*) as rows, 'exact' as kind from exact group by split
union all select {side('o_orderkey')}, count(*), 'hash' from orders group by 1"""

SQL["load_and_split"] = WITH_SPLIT + f"""
select split, count(*) as rows, cast(sum("Is_Year_Placeholder") as bigint) as placeholders,
       round(avg("Machine_Age"), 4) as mean_age, round(avg(sale_price), 2) as mean_price
from ({ENGINEERED}) group by split"""

SQL["group_medians"] = WITH_SPLIT + median_rows(
    ("hours", "year_made", "sale_price"), "parted", "product_group")
SQL["global_medians"] = WITH_SPLIT + median_rows(
    ("hours", "year_made", "sale_price", "o_totalprice", "l_extendedprice"), "parted")

SQL["impute_missing"] = WITH_SPLIT + f""",
gm as (select product_group as k, median(hours) as h, median(year_made) as ym
       from parted where split = 'train' and product_group is not null group by 1),
am as (select median(hours) as h, median(year_made) as ym from parted where split = 'train')
select {K}, split, coalesce(product_group, 'Unknown') as product_group,
       coalesce(usage_band, 'Unknown') as usage_band,
       coalesce(hours, gm.h, am.h) as hours,
       coalesce(cast(year_made as double), gm.ym, am.ym) as year_made
from parted cross join am left join gm on product_group = gm.k"""

SQL["target_encode_fit"] = WITH_SPLIT + " union all ".join(
    f"select '{n}' as feature, {n} as level, round(avg(sale_price), 2) as mean, count(*) as n"
    f" from parted where split = 'train' and {n} is not null group by {n}"
    for n in ("model_desc", "class_desc", "product_group"))

ENCODINGS = """
tm as (select avg(sale_price) as m from parted where split = 'train'),
te1 as (select model_desc as k, avg(sale_price) as m from parted where split = 'train' group by 1),
te2 as (select class_desc as k, avg(sale_price) as m from parted where split = 'train' group by 1),
te3 as (select product_group as k, avg(sale_price) as m from parted where split = 'train' group by 1)"""

SQL["target_encode_apply"] = WITH_SPLIT + f""", {ENCODINGS}
select {K}, split, round(coalesce(te2.m, tm.m), 2) as class_desc,
       round(coalesce(te1.m, tm.m), 2) as model_desc,
       round(coalesce(te3.m, tm.m), 2) as product_group
from parted cross join tm left join te1 on model_desc = te1.k
     left join te2 on class_desc = te2.k left join te3 on product_group = te3.k"""

ONE_HOT = ("usage_band", "p_type", "c_mktsegment", "product_group")
SQL["level_counts"] = WITH_SPLIT + level_rows(ONE_HOT)

SQL["rare_levels"] = WITH_SPLIT + f"""
select feature, level, n, cast(n < 25 as integer) as is_rare
from ({level_rows(("usage_band", "class_desc", "c_name"))}) where level is not null"""


def grouped(column: str, rare_below: int) -> str:
    return (f"case when {column} in (select {column} from parted where split = 'train'"
            f" and {column} is not null group by {column} having count(*) >= {rare_below})"
            f" then {column} else 'Other' end")


SQL["group_rare"] = WITH_SPLIT + f"""
select {K}, split, {grouped("usage_band", 400)} as usage_band, {grouped("class_desc", 400)} as class_desc
from parted"""

# The levels of the test tables: baseline first, then one column each.
BANDS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))


def dummies(column: str, levels: list[str], extra: tuple[str, ...]) -> list[str]:
    """Level columns; ``Other`` takes missing and rare values, ``Unknown`` stays 0."""
    out = [f"""case when {column} = '{v}' then 1 else 0 end as "{column}_{v}\"""" for v in levels[1:]]
    if "Other" in extra:
        listed = ", ".join(f"'{v}'" for v in levels)
        out.append(f"""case when coalesce({column}, '') in ({listed}) then 0 else 1 end as "{column}_Other\"""")
    if "Unknown" in extra:
        out.append(f'cast(0 as integer) as "{column}_Unknown"')
    return out


DUMMIES = ", ".join([
    *dummies("usage_band", BANDS, ("Other", "Unknown")), *dummies("p_type", TYPES, ()),
    *dummies("c_mktsegment", SEGMENTS, ()), *dummies("product_group", BRANDS, ("Unknown",))])

SQL["onehot"] = WITH_SALE + f"select {K}, {DUMMIES} from sale"

SQL["onehot_unknown"] = WITH_SALE + f"""
select {K}, {", ".join(dummies("usage_band", BANDS, ())) },
       cast(coalesce(usage_band = 'RARE-A', false) as integer) as "usage_band_Other",
       cast(usage_band is null as integer) as "usage_band_Unknown" from sale"""

FILLED_BY_GROUP = ("hours", "Horsepower", "Weight_Tons", "year_made")
FILLED = ("Sale_Year", "Sale_Month", "Sale_Quarter", "Machine_Age")


def preprocessed(part: str, targets: str) -> str:
    gm = ", ".join(f'median("{n}") as "{n}"' for n in FILLED_BY_GROUP)
    am = ", ".join(f'median("{n}") as "{n}"' for n in (*FILLED_BY_GROUP, *FILLED))
    filled = ", ".join(
        [f'coalesce(cast(e."{n}" as double), gm."{n}", am."{n}", 0) as "{n}"' for n in FILLED_BY_GROUP]
        + [f'coalesce(cast(e."{n}" as double), am."{n}", 0) as "{n}"' for n in FILLED])
    return WITH_SPLIT + f""", {ENCODINGS}, e as ({ENGINEERED}),
gm as (select product_group as k, {gm} from e where split = 'train' and product_group is not null group by 1),
am as (select {am} from e where split = 'train')
select {K}, l_quantity, l_discount, l_extendedprice, o_totalprice, {filled},
       cast("Is_Year_Placeholder" as double) as "Is_Year_Placeholder",
       coalesce("Digging_Depth_Ft", 0.0) as "Digging_Depth_Ft",
       cast("Has_Hours" as double) as "Has_Hours",
       round(coalesce(te1.m, tm.m), 2) as model_desc, round(coalesce(te2.m, tm.m), 2) as class_desc,
       {DUMMIES}, {targets}
from e cross join am cross join tm left join gm on product_group = gm.k
     left join te1 on model_desc = te1.k left join te2 on class_desc = te2.k
where split = '{part}'"""


SQL["preprocess_train"] = preprocessed("train", f"""
       round({CLIPPED}, 6) as sale_price, round(ln(1 + {CLIPPED}), 6) as log_sale_price""")
SQL["preprocess_test"] = preprocessed("test", "round(sale_price, 6) as sale_price")
SQL["reloaded_preprocess"] = SQL["preprocess_test"]

SQL["residuals"] = WITH_PREDICTIONS + f"""
select {K}, round(y, 6) as y, prediction, round(y - prediction, 6) as residual,
       round(abs(y - prediction), 6) as abs_error from chosen"""

SQL["metrics"] = WITH_PREDICTIONS + f"""
select split, model, {errors()} from predictions group by split, model"""

SQL["evaluate_log_predictions"] = WITH_PREDICTIONS + f"""
select {errors()} from (select y, exp(ln(1 + prediction)) - 1 as prediction from chosen)"""

SQL["compare_models"] = WITH_PREDICTIONS + f"""
select model, {errors()} from predictions where split = 'val' group by model"""

SQL["log_rmse"] = WITH_PREDICTIONS + """
select model, round(sqrt(avg(pow(ln(1 + y) - ln(1 + prediction), 2))), 6) as rmse
from predictions where split = 'val' group by model"""

SQL["summary"] = WITH_PREDICTIONS + f""",
scores as (select split, model, {errors(9)} from predictions group by split, model),
winner as (select model from scores where split = 'val' order by "R2" desc limit 1),
tall as (unpivot (select * from scores where split <> 'train' and model in (select model from winner))
         on "MAE", "RMSE", "R2", "MAPE" into name metric value v)
select model, metric, round(max(case when split = 'val' then v end), 5) as validation,
       round(max(case when split = 'test' then v end), 5) as test
from tall group by model, metric"""

SQL["quantile_residuals"] = WITH_PREDICTIONS + f""",
edges as (select quantile_cont(y, [0.2, 0.4, 0.6, 0.8]) as e from chosen)
select case when y <= e[1] then 'Very Low' when y <= e[2] then 'Low' when y <= e[3] then 'Medium'
            when y <= e[4] then 'High' else 'Very High' end as segment, count(*) as count, {errors()}
from chosen cross join edges group by 1"""

SQL["worst_predictions"] = WITH_PREDICTIONS + f"""
select {K}, round(y, 4) as true_price, round(prediction, 4) as predicted_price,
       round(abs(y - prediction), 4) as error,
       round(abs(y - prediction) / nullif(y, 0) * 100, 4) as error_percent
from chosen order by abs(y - prediction) desc, {K} limit 25"""

SQL["best_model"] = WITH_PREDICTIONS + f""",
scores as (select model, {errors()} from predictions where split = 'val' group by model)
select *, 'R2' as chosen_by from scores where model = (select arg_max(model, "R2") from scores)
union all
select *, 'MAPE' from scores where model = (select arg_min(model, "MAPE") from scores)"""

SQL["leaderboard"] = WITH_PREDICTIONS + f"""
select model, {errors()} from predictions where split = 'test' group by model order by "MAE" """

SQL["best_iteration"] = WITH_PREDICTIONS + """,
level as (select distinct prediction as m from predictions where model = 'overall'),
sums as (select model, avg((y - m) * (y - m)) as aa, avg((y - m) * (prediction - m)) as ab,
                avg((prediction - m) * (prediction - m)) as bb
         from predictions cross join level where split = 'val' and model <> 'overall' group by model),
curve as (select model, cast(i as integer) as iteration,
                 round(sqrt(aa - 2 * (i / 20.0) * ab + (i / 20.0) * (i / 20.0) * bb), 5) as rmse
          from sums cross join range(1, 61) t(i)),
marked as (select *, rmse < coalesce(min(rmse) over (partition by model order by iteration
                     rows between unbounded preceding and 1 preceding), 1e300) as record from curve),
placed as (select *, max(case when record then iteration end) over
                     (partition by model order by iteration) as best from marked),
ended as (select *, coalesce(max(case when iteration - best >= 8 then 1 else 0 end) over
                    (partition by model order by iteration
                     rows between unbounded preceding and 1 preceding), 0) as over_before from placed)
select model, max(best) as best_iteration, min(case when record then rmse end) as best_rmse,
       max(iteration) as last,
       cast(max(case when iteration - best >= 8 then 1 else 0 end) as integer) as stopped
from ended where over_before = 0 group by model"""

WITH_TWO = WITH_SPLIT + f""",
rows as (select {K}, split, l_quantity as a, l_discount as b, sale_price,
                ln(1 + case when split = 'train' then {CLIPPED} else sale_price end) as y from parted) """

RIDGE_TWO = """,
s as (select count(*) as n, avg(a) as ma, avg(b) as mb, avg(y) as my,
             var_pop(a) * count(*) + 1 as saa, var_pop(b) * count(*) + 1 as sbb,
             covar_pop(a, b) * count(*) as sab, covar_pop(a, y) * count(*) as say,
             covar_pop(b, y) * count(*) as sby
      from rows where split = 'train'),
w as (select (sbb * say - sab * sby) / (saa * sbb - sab * sab) as wa,
             (saa * sby - sab * say) / (saa * sbb - sab * sab) as wb, ma, mb, my from s),
terms as (select wa, wb, my - wa * ma - wb * mb as w0 from w) """

SQL["ridge_one_feature"] = WITH_TWO + """,
s as (select avg(a) as ma, avg(y) as my, regr_sxy(y, a) / (regr_sxx(y, a) + 1000.0) as wa
      from rows where split = 'train')
select 'intercept' as term, round(my - wa * ma, 7) as value from s
union all select 'l_quantity', round(wa, 7) from s"""

SQL["ridge_two_features"] = WITH_TWO + RIDGE_TWO + """
select 'intercept' as term, round(w0, 7) as value from terms
union all select 'l_quantity', round(wa, 7) from terms
union all select 'l_discount', round(wb, 7) from terms"""

SQL["feature_importance_linear"] = WITH_TWO + RIDGE_TWO + """
select 'l_quantity' as feature, round(abs(wa), 7) as importance from terms
union all select 'l_discount', round(abs(wb), 7) from terms"""

SQL["ridge_predictions"] = WITH_TWO + RIDGE_TWO + f"""
select {K}, 'ridge' as model, round(sale_price, 4) as y,
       round(exp(w0 + wa * a + wb * b) - 1, 4) as prediction
from rows cross join terms where split = 'test'"""

SQL["score"] = WITH_TWO + RIDGE_TWO + f"""
select {K}, round(exp(w0 + wa * a + wb * b) - 1, 4) as predicted_price
from rows cross join terms"""


def best_split(source: str) -> str:
    """The cut of ``a`` or ``b`` that lowers the squared error of ``t`` most, with both means."""
    sides = " union all ".join(
        f"""select '{f}' as f, {f} as cut, sum(c) over w as nl, sum(s) over w as sl,
                   sum(c) over () as n, sum(s) over () as st
            from (select {f}, count(*) as c, sum(t) as s from {source} group by {f})
            window w as (order by {f})""" for f in ("a", "b"))
    return f"""select f, cut, sl / nl as ml, (st - sl) / (n - nl) as mr,
                   sl * sl / nl + (st - sl) * (st - sl) / (n - nl) - st * st / n as gain from ({sides})
               where nl < n order by sl * sl / nl + (st - sl) * (st - sl) / (n - nl) desc limit 1"""


def leaf(cut: str) -> str:
    return (f"case when (case when {cut}.f = 'a' then a else b end) <= {cut}.cut"
            f" then {cut}.ml else {cut}.mr end")


SQL["gbt_stumps"] = WITH_TWO + f""",
fit1 as (select a, b, y as t from rows where split = 'train'),
cut1 as ({best_split("fit1")}),
fit2 as (select a, b, y - {leaf("cut1")} as t from rows cross join cut1 where split = 'train'),
cut2 as ({best_split("fit2")})
select {K}, round({leaf("cut1")} + 0.5 * {leaf("cut2")}, 7) as log_prediction
from rows cross join cut1 cross join cut2 where split = 'val'"""


def boosted(rounds: int, rate: float, name: str = "s") -> str:
    """CTEs of rounds of one-split trees: ``{name}_cut{k}``, and in ``{name}{k}`` what ``k`` rounds leave of the target."""
    steps = [f"{name}0 as materialized (select {K}, split, a, b, sale_price, y, y as t from rows)"]
    for k in range(1, rounds + 1):
        cut, before = f"{name}_cut{k}", f"{name}{k - 1}"
        train_side = f"(select * from {before} where split = 'train')"
        steps.append(f"{cut} as materialized ({best_split(train_side)})")
        weight = 1.0 if k == 1 else rate
        steps.append(f"{name}{k} as materialized (select {before}.* replace (t - {weight} * ({leaf(cut)}) as t)"
                     f" from {before} cross join {cut})")
    return ",\n".join(steps)


def stump_errors(rounds: int, name: str = "s", label: str = "") -> str:
    """``(iteration, rmse)`` on the validation rows."""
    return " union all ".join(
        f"select {label}{k} as iteration, sqrt(avg(t * t)) as rmse from {name}{k} where split = 'val'" for k in range(1, rounds + 1))


SQL["gbt_rounds"] = WITH_TWO + f""",
{boosted(6, 0.5)}
select 'boosted_trees' as model, iteration, round(rmse, 7) as rmse from ({stump_errors(6)})"""

SQL["gbt_stump_importance"] = WITH_TWO + f""",
{boosted(6, 0.5)},
errors as ({stump_errors(6)}),
best as (select iteration as k from errors order by rmse, iteration limit 1),
gains as ({" union all ".join(f"select {k} as k, f, gain from s_cut{k}" for k in range(1, 7))}),
used as (select f, gain from gains where gains.k <= (select k from best))
select feature, round(coalesce(sum(gain), 0) / (select sum(gain) from used), 7) as importance
from (values ('l_quantity', 'a'), ('l_discount', 'b')) names(feature, f) left join used using (f) group by feature"""

SQL["train_stumps"] = WITH_TWO + RIDGE_TWO + f""",
{boosted(6, 0.5)},
errors as ({stump_errors(6)}),
best as (select iteration as k from errors order by rmse, iteration limit 1),
stumped as ({" union all ".join(f"select {k} as k, sale_price as y, exp(y - t) - 1 as prediction from s{k} where split = 'val'" for k in range(1, 7))}),
scored as (
  select 'ridge' as model, sale_price as y, exp(w0 + wa * a + wb * b) - 1 as prediction from rows cross join terms where split = 'val'
  union all select 'boosted_trees', y, prediction from stumped where k = (select k from best))
select model, {errors()} from scored group by model"""

POINT_RATES = (0.2, 0.8, 0.5)
SQL["search_stumps"] = WITH_TWO + ",\n" + ",\n".join(boosted(6, rate, f"p{i}_") for i, rate in enumerate(POINT_RATES)) + f""",
errors as ({" union all ".join(stump_errors(6, f"p{i}_", f"{i} as trial, ") for i in range(len(POINT_RATES)))}),
first as (select trial, min(rmse) as rmse from errors where iteration <= 2 group by trial),
left_over as (select trial from first order by rmse, trial limit 1),
counted as (select e.*, e.trial = l.trial as goes_on from errors e cross join left_over l),
seen as (select * from counted where goes_on or iteration <= 2)
select cast(trial as integer) as trial, round(min(rmse), 7) as rmse, cast(arg_min(iteration, rmse) as integer) as best_iteration,
       cast(max(iteration) as integer) as rounds, case when bool_or(goes_on) then 'cap' else 'halved' end as ended
from seen group by trial"""

SQL["ridge_conjugate"] = SQL["ridge_two_features"]

WIDE = ("c_name", "class_desc", "usage_band")
SQL["wide_onehot"] = WITH_SPLIT + f""",
counts as ({level_rows(WIDE)}),
kept as (select feature, level from counts where level is not null and n >= 25),
words as (select distinct feature, 'Other' as level from counts where level is not null and n < 25
          union select feature, 'Unknown' from counts where level is null),
levels as (select feature, level, row_number() over (partition by feature order by level) - 1 as position
           from (select * from kept union select * from words)),
widths as (select f.feature, f.place, coalesce(max(position), 0) as width
           from (values {", ".join(f"('{f}', {i})" for i, f in enumerate(WIDE))}) f(feature, place)
           left join levels using (feature) group by 1, 2),
starts as (select feature, coalesce(sum(width) over (order by place rows between unbounded preceding and 1 preceding), 0) as start from widths),
numbered as materialized (select *, row_number() over () as row_id from parted),
cells as ({" union all ".join(f"select row_id, '{f}' as feature, coalesce({f}, 'Unknown') as level from numbered" for f in WIDE)}),
read as (select c.*, case when k.level is null then 'Other' else c.level end as word
         from cells c left join kept k on k.feature = c.feature and k.level = c.level),
placed as (select row_id, start + position - 1 as entry
           from read join levels l on l.feature = read.feature and l.level = read.word join starts on starts.feature = read.feature
           where position > 0),
listed as (select row_id, string_agg(cast(cast(entry as bigint) as varchar), ',' order by entry) as entries from placed group by row_id)
select {K}, coalesce(entries, '') as entries from numbered left join listed using (row_id)"""


def histogram_sql(source: str, x: str, bins: int) -> str:
    return f"""
span as (select min({x}) as lo, max({x}) as hi, count({x}) as n,
                (max({x}) - min({x})) / {bins} as w from {source}),
counted as (select cast(least(floor(({x} - lo) / w), {bins - 1}) as integer) as bin, count(*) as c
            from {source} cross join span group by 1)
select cast(i as integer) as bin, round(lo + i * w, 9) as lower, round(lo + (i + 1) * w, 9) as upper,
       coalesce(c, 0) as count, round(coalesce(c, 0) / (n * w), 9) as density
from range({bins}) t(i) cross join span left join counted on counted.bin = i"""


SQL["histogram"] = "with " + histogram_sql("orders", "o_totalprice", 80)
SQL["residual_histogram"] = WITH_PREDICTIONS + """,
res as (select y - prediction as r from chosen), """ + histogram_sql("res", "r", 70)

SQL["kde"] = WITH_SALE + """,
x as (select sale_price as v, count(*) as c from sale group by 1),
span as (select min(sale_price) as lo, max(sale_price) as hi, count(*) as n,
                stddev_samp(sale_price) * pow(count(*), -0.2) as h from sale)
select cast(i as integer) as point, round(lo + i * (hi - lo) / 499, 4) as x,
       round(sum(c * exp(-0.5 * pow((lo + i * (hi - lo) / 499 - v) / h, 2)))
             / (n * h * sqrt(2 * pi())), 11) as density
from x cross join span cross join range(500) t(i) group by i, lo, hi, n, h"""

SQL["target_summary"] = WITH_SALE + """
select count(sale_price) as n, round(avg(sale_price), 4) as mean, round(median(sale_price), 4) as median,
       round(stddev_samp(sale_price), 4) as std from sale"""

SQL["residual_summary"] = WITH_PREDICTIONS + """
select round(avg(y - prediction), 5) as mean, round(stddev_pop(y - prediction), 5) as std,
       round(skewness(y - prediction), 5) as skew from chosen"""

SQL["scatter"] = WITH_PREDICTIONS + """,
span as (select 1.05 * greatest(max(y), max(prediction)) / 60 as w from chosen)
select cast(least(floor(y / w), 59) as integer) as y_bin,
       cast(least(floor(prediction / w), 59) as integer) as prediction_bin,
       count(*) as count, round(sum(abs(y - prediction)), 4) as total_abs_error
from chosen cross join span group by 1, 2"""

SQL["binned_trend"] = WITH_PREDICTIONS + """,
span as (select min(prediction) as lo, (max(prediction) - min(prediction)) / 50 as w from chosen)
select cast(least(floor((prediction - lo) / w), 49) as integer) as bin, count(*) as count,
       round(sum(prediction), 4) as total_prediction, round(sum(y - prediction), 4) as total_residual,
       round(stddev_pop(y - prediction), 4) as std_residual
from chosen cross join span group by 1"""


TARGET_BINS = WITH_SALE + ", " + histogram_sql("sale", "sale_price", 80)
FIXED_TABLES = {"target_kde": 500, "target_summary": 1, "model_metrics": 1, "residual_kde": 500, "residual_summary": 1, "residual_smooth": 100,
                "model_comparison": 3, "business_impact": 1}
SQL["all_tables"] = " union all ".join([
    *[f"""select '{name}' as "table", cast({n} as bigint) as n_rows, cast(null as bigint) as total""" for name, n in FIXED_TABLES.items()],
    *[f"select '{name}', count(*), cast(sum(count) as bigint) from ({SQL[twin] if twin else TARGET_BINS})" for name, twin in (
        ("target_histogram", None), ("actual_vs_predicted", "scatter"), ("residual_histogram", "residual_histogram"),
        ("residual_trend", "binned_trend"))]])

SQL["business_impact"] = WITH_PREDICTIONS + """,
mid as (select median(y) as m from chosen),
maes as (select 'median_predictor' as baseline, avg(abs(y - m)) as baseline_mae,
                avg(abs(y - prediction)) as model_mae from chosen cross join mid
         union all
         select 'median_price', any_value(m), avg(abs(y - prediction)) from chosen cross join mid)
select baseline, round(baseline_mae, 3) as baseline_mae, round(model_mae, 3) as model_mae,
       round(baseline_mae - model_mae, 3) as improvement,
       round((baseline_mae - model_mae) / baseline_mae * 100, 3) as improvement_percent,
       round((baseline_mae - model_mae) * 10000, 3) as annual_savings
from maes"""

SQL["csv_source"] = WITH_SALE + """
select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, round(sale_price, 6) as sale_price, class_desc, hours as hours_meter,
       usage_band as "usage band", product_group as "product group",
       cast(year_made as double) as year from sale"""

SQL["report_csv"] = WITH_PREDICTIONS + f"""
select model, {errors()} from predictions where split = 'test' group by model"""

SQL["saved_params"] = WITH_TWO + """,
s as (select count(*) as n, avg(a) as ma, avg(b) as mb, avg(y) as my,
             var_pop(a) * count(*) as vaa, var_pop(b) * count(*) as vbb,
             covar_pop(a, b) * count(*) as sab, covar_pop(a, y) * count(*) as say,
             covar_pop(b, y) * count(*) as sby
      from rows where split = 'train'),
grid as (select alpha, vaa + alpha as saa, vbb + alpha as sbb, sab, say, sby, ma, mb, my
         from s cross join (values (0.1), (1000.0), (100000.0)) t(alpha)),
w as (select alpha, (sbb * say - sab * sby) / (saa * sbb - sab * sab) as wa,
             (saa * sby - sab * say) / (saa * sbb - sab * sab) as wb, ma, mb, my from grid),
scored as (select alpha, sqrt(avg(pow(y - (my + wa * (a - ma) + wb * (b - mb)), 2))) as rmse
           from rows cross join w where split = 'val' group by alpha)
select cast(alpha as double) as alpha, round(rmse, 6) as rmse from scored order by scored.rmse limit 1"""
