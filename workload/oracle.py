"""The same results in DuckDB SQL, over the registered base tables."""

from __future__ import annotations

import re

from venuekit.plans.sentiment import Rules
from workload.inputs import REMARKS, VALENCES


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(words) -> str:
    return ", ".join(map(_quoted, words))


_PUNCTUATION = _quoted("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")

_RULES = Rules()
_WEAKER = _listed(_RULES.weaker_phrases)


def _step(back: int, decay: str, exception: str = "false", factor: float = 1.0) -> str:
    """The effect of one of the words before on a valence, as plain SQL."""
    b, k = f"b{back}", f"(0.293::double * {decay}::double)"
    degree = f"case when {b} in ({_listed(_RULES.stronger)}) then {k} when {b} in ({_listed(_RULES.weaker)}) then -{k} else 0.0::double end"
    negated = f"{b} in ({_listed(_RULES.negations)}) or {b} like '%n''t%'"
    return f"""
select * replace (case when v is null or {b} is null or not far{back} then v else
  (v + case when v < 0 then -1 else 1 end * {degree})
  * case when {exception} then {factor}::double when {negated} then -0.74::double else 1.0::double end end as v)
from fx_v{back - 1}"""


def _idiom(*words: str) -> str:
    whens = " ".join(f"when {_quoted(phrase)} then {value}::double" for phrase, value in _RULES.idioms.items())
    # || gives NULL where a word is missing
    return f"case {" || ' ' || ".join(words)} {whens} end"


_RUNS = (("word", "n1", "n2"), ("b2", "b1", "word"), ("b3", "b2", "b1"), ("word", "n1"), ("b1", "word"), ("b2", "b1"), ("b3", "b2"))
_IDIOMS = ", ".join(_idiom(*run) for run in _RUNS)

INPUTS = {
    "fx_business": """
select s_suppkey as BusinessID, s_name as Name, n_name as City, r_name as State,
  concat('M', n_nationkey, 'A ', s_suppkey % 10, 'B1') as PostalCode,
  43.0::double + (s_suppkey % 50) / 100.0::double as Latitude,
  -79.0::double - (s_suppkey % 40) / 100.0::double as Longitude,
  (s_suppkey % 9 + 2) / 2.0::double as BusinessStars,
  case s_suppkey % 4 when 0 then 'Restaurants, Food, Italian'
    when 1 then 'Food, Restaurants, Asian Fusion' when 2 then 'Shopping, Fast Food'
    else 'Restaurants, Fast Food, Chinese' end as Categories,
  s_suppkey % 97 as ReviewCount, case when s_suppkey % 5 = 0 then 0 else 1 end as is_open
from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""",
    "fx_review": """
select l_orderkey * 10 + l_linenumber as ReviewID, o_custkey as UserID, l_suppkey as BusinessID,
  cast(ceil(l_quantity / 10) as int) as ReviewStars, cast(l_shipdate as date) as Date
from lineitem join orders on l_orderkey = o_orderkey""",
    "fx_user": """
select c_custkey as UserID, c_name as UserName, count(o_orderkey) as ReviewCount,
  cast(min(o_orderdate) as date) as YelpingSince,
  round(1 + avg(o_totalprice) / 125000, 2) as AverageStars
from customer left join orders on c_custkey = o_custkey group by c_custkey, c_name""",
    "fx_checkin": "select user_id as BusinessID, ts as CheckinDate from events",
    "fx_text": """
select doc_id as ReviewID, cast(replace(source, 'src', '') as bigint) as BusinessID, text as Review
from documents""",
    "fx_area": """
select n_name as Neighbourhood, concat('M', n_nationkey, 'A') as PostCode,
  count(*) as TotalPopulation,
  count(*) filter (c_mktsegment = 'HOUSEHOLD') as SouthAsian,
  count(*) filter (c_acctbal > 0) as LabourForceCategory,
  case when n_nationkey <> 3 then count(*) filter (c_acctbal > 2500) end as InLabourForce
from customer join nation on c_nationkey = n_nationkey group by n_name, n_nationkey""",
    "fx_attributes": """
select s_suppkey as BusinessID, case when s_suppkey % 17 = 0 then null when s_suppkey % 13 = 0 then 'free WiFi' else
  concat('{"Price":"', s_suppkey % 4, '","WiFi":"',
  case when s_suppkey % 3 = 0 then 'None' else 'free' end,
  '","Ambience":"{''casual'': ', case when s_suppkey % 2 = 0 then 'True' else 'False' end,
  case when s_suppkey % 11 = 0 then '"}' else ', u''quiet'': u''none''}"}' end) end as Attributes
from supplier""",
    "fx_parsed": "select * from supplier where s_suppkey % 17 <> 0 and s_suppkey % 13 <> 0",
    "fx_attr_rows": """
select s_suppkey as BusinessID, 'Price' as attr_key, cast(s_suppkey % 4 as varchar) as attr_val from fx_parsed
union all select s_suppkey, 'WiFi', 'free' from fx_parsed where s_suppkey % 3 <> 0
union all select s_suppkey, 'Ambience_casual', case when s_suppkey % 2 = 0 then 'True' else 'False' end
from fx_parsed where s_suppkey % 11 <> 0""",
    "fx_spread": """
select ReviewID, ReviewID % (select count(*) from supplier) as BusinessID, Review from fx_text""",
    "fx_business_terms": r"""
select BusinessID, term, count(*) as n from (
  select BusinessID, unnest(regexp_extract_all(lower(Review), '\w+')) as term from (select distinct BusinessID, Review from fx_spread))
where term not in ('the', 'and', 'of', 'to', 'in', 'that') group by all""",
    "fx_weights": """
select BusinessID, n * ln(((select count(distinct BusinessID) from fx_spread) + 1)
  / (count(*) over (partition by term) + 1)::double) as weight from fx_business_terms""",
    "fx_raw_reviews": """
select ReviewID, ReviewID % 50 as UserID, case when ReviewID % 10 = 0 then -1 else BusinessID end as BusinessID,
  (ReviewID % 9 + 1) / 2.0::double as ReviewStars, ReviewID % 4 as useful,
  case ReviewID % 8 when 0 then concat('line one', chr(10), 'line two ', Review) when 1 then ' ' when 2 then chr(10) || ' '
    when 3 then null else Review end as txt,
  case when ReviewID % 6 > 2 then make_date(2010 + ReviewID % 14, 1 + ReviewID % 12, 1 + ReviewID % 28) end as Date
from fx_text""",
    "fx_lexicon": """
select * from (values ('the', 1.5::double), ('and', -1.0), ('that', 2.0), ('with', -2.5),
  ('les', 0.8), ('und', -1.7), """
    + ", ".join(f"('{token}', {value})" for token, value in VALENCES)
    + ") t(token, valence)",
    "fx_remarks": f"""
select ReviewID, BusinessID, concat(Review, ' ', [{_listed(REMARKS)}][ReviewID % {len(REMARKS)} + 1]) as Review
from fx_text where Review is not null
union all select ReviewID, BusinessID, Review from fx_text where Review is null""",
    "fx_sentiment": """
select r.BusinessID, Name, replace(PostalCode, ' ', '') as ZipCode, Latitude, Longitude,
  round(avg(case when ReviewStars <= 2 then 1.0::double else 0 end), 2) as avg_neg,
  round(avg(case when ReviewStars = 3 then 1.0::double else 0 end), 2) as avg_neu,
  round(avg(case when ReviewStars >= 4 then 1.0::double else 0 end), 2) as avg_pos,
  round(avg(ReviewStars / 5.0::double), 2) as avg_composite_score
from fx_review r join fx_business b on r.BusinessID = b.BusinessID
group by r.BusinessID, Name, PostalCode, Latitude, Longitude""",
    "fx_category": """
select BusinessID, replace(unnest(string_split(Categories, ',')), ' ', '') as Category from fx_business""",
    "fx_raw": """
select b.*, a.Attributes from fx_business b join fx_attributes a using (BusinessID)
where is_open = 1 and PostalCode is not null and BusinessStars is not null and Latitude is not null
  and Longitude is not null and ReviewCount is not null and Categories is not null
  and State in (select r_name from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey where c_acctbal < 0)""",
    "fx_words": r"""
select ReviewID, unnest(regexp_extract_all(lower(Review), '\w+')) as term from fx_text""",
    "fx_counts": """
select ReviewID, term, count(*) as n from fx_words
where term not in ('the', 'and', 'of', 'to', 'in', 'that') group by all""",
    "fx_ascii": r"""
select *, regexp_replace(lower(Review), '[^\x01-\x7E]', '', 'g') as txt from fx_remarks""",
    "fx_raw_words": r"""
select ReviewID, unnest(words) as raw, generate_subscripts(words, 1) as nth
from (select ReviewID, list_filter(regexp_split_to_array(txt, '[ \t\n\x0B\f\r]+'), lambda w: length(w) > 1) as words from fx_ascii)""",
    "fx_tokens": f"""
select *, lag(word, 1) over w as b1, lag(word, 2) over w as b2, lag(word, 3) over w as b3,
  lead(word, 1) over w as n1, lead(word, 2) over w as n2
from (select *, case when length(trim(raw, {_PUNCTUATION})) > 1 then trim(raw, {_PUNCTUATION}) else raw end as word from fx_raw_words)
window w as (partition by ReviewID order by nth)""",
    "fx_but": "select ReviewID, min(nth) as but_nth from fx_tokens where word = 'but' group by ReviewID",
    "fx_listed": """
select t.*, coalesce(a.valence, b.valence) as valence
from fx_tokens t left join fx_lexicon a on raw = a.token left join fx_lexicon b on word = b.token""",
    "fx_v0": f"""
select *, lag(valence, 1) over w is null as far1, lag(valence, 2) over w is null as far2, lag(valence, 3) over w is null as far3,
  case when word in ({_listed([*_RULES.stronger, *_RULES.weaker])}) or (word = 'kind' and coalesce(n1, '') = 'of') then null else valence end as v
from fx_listed window w as (partition by ReviewID order by nth)""",
    "fx_v1": _step(1, "1.0"),
    "fx_v2": _step(2, "0.95", "b2 = 'never' and b1 in ('so', 'this')", 1.5),
    "fx_v3": _step(3, "0.9", "(b3 = 'never' and b2 in ('so', 'this')) or b1 in ('so', 'this')", 1.25),
    "fx_v4": f"""
select * replace (case when b3 is null or not far3 then v else
  coalesce({_IDIOMS}, v) - case when concat(b2, ' ', b1) in ({_WEAKER}) or concat(b3, ' ', b2) in ({_WEAKER}) then 0.293::double else 0 end end as v)
from fx_v3 where v is not null""",
    "fx_v5": """
select * replace (case when b1 = 'least' and far1 and coalesce(b2, '') not in ('at', 'very') then v * -0.74::double else v end as v)
from fx_v4""",
    "fx_emphasis": """
select ReviewID, BusinessID, Review,
  least(length(txt) - length(replace(txt, '!', '')), 4) * 0.292::double
  + case when q <= 1 then 0.0::double when q <= 3 then q * 0.18::double else 0.96::double end as e
from (select *, length(txt) - length(replace(txt, '?', '')) as q from fx_ascii)""",
    "fx_sums": """
select r.ReviewID, r.BusinessID, r.Review, e, coalesce(sum(x), 0.0) as s,
  coalesce(sum(case when x > 0 then x + 1 else 0.0::double end), 0.0) as up,
  coalesce(sum(case when x < 0 then 1 - x else 0.0::double end), 0.0) as down,
  count(*) filter (x = 0) as flat
from fx_emphasis r left join (
  select t.ReviewID, coalesce(v, 0.0::double) * case when but_nth is null or t.nth = but_nth then 1.0::double
    when t.nth < but_nth then 0.5::double else 1.5::double end as x
  from fx_tokens t left join fx_v5 f on t.ReviewID = f.ReviewID and t.nth = f.nth
  left join fx_but b on t.ReviewID = b.ReviewID) x on r.ReviewID = x.ReviewID
group by all""",
    "fx_scores": """
select ReviewID, BusinessID, Review,
  round(case when whole = 0 then 0.0 else down / whole end, 3) as Negative,
  round(case when whole = 0 then 0.0 else flat / whole end, 3) as Neutral,
  round(case when whole = 0 then 0.0 else up / whole end, 3) as positive,
  round(s / sqrt(s * s + 15), 4) as Over_all
from (select *, up + down + flat as whole from (
  select ReviewID, BusinessID, Review, flat, s + sign(s) * e as s,
    up + case when up > down then e else 0.0 end as up,
    down + case when down > up then e else 0.0 end as down from fx_sums))""",
}


def _with_inputs(sql: str) -> str:
    """Put the inputs that a statement names, and those they name, in front of it."""
    needed: list[str] = []

    def visit(body: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bfx_\w+", body)):
            if name not in needed:
                visit(INPUTS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql.strip()
    # Inputs used by several others are computed once.
    ctes = ",\n".join(f"{n} as materialized ({INPUTS[n]})" for n in needed)
    return f"with {ctes}\n{sql.strip()}"


def _mean(score: str) -> str:
    """Exact mean of a four-digit score, rounded half up to two digits."""
    units = f"sum(cast(round({score} * 10000) as bigint))"
    half_up = f"(abs({units}) * 2 + count(*) * 100) // (count(*) * 200)"
    return f"cast(sign({units}) * ({half_up}) as double) / 100"


_EMPLOYMENT = """
select Neighbourhood, round(avg(BusinessStars), 6) as BusinessStars,
  round(avg(InLabourForce / cast(LabourForceCategory as double)), 6) as ratio_emply
from fx_business join fx_area on split_part(PostalCode, ' ', 1) = PostCode
where InLabourForce is not null and {city} group by Neighbourhood"""

_RANGE = "cast((ReviewCount // {w}) * {w} as varchar) || '-' || cast((ReviewCount // {w}) * {w} + {w} - 1 as varchar)"

_HASH = "cast('0x' || substr(md5('{seed}|' || cast({key} as varchar)), 1, 8) as bigint)"

_SERVED = "(select UserID, UserName, AverageStars from fx_user where UserID % 20 = 0)"
_NOT_VISITED = "not exists (select 1 from fx_review r where r.UserID = u.UserID and r.BusinessID = b.BusinessID)"

SQL = {
    # --- sources
    "scan_parquet": "select * from customer",
    "normalise_headers": "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier",
    "sql_view": "select c_mktsegment, count(*) as n from customer where c_acctbal > 0 group by 1",
    "html_rows": r"""
select page_id, cast(generate_subscripts(found, 1) - 1 as int) as pos,
  regexp_extract(unnest(found), '<li><a href="([^"]*)">([^<]*)</a>', 1) as href,
  regexp_extract(unnest(found), '<li><a href="([^"]*)">([^<]*)</a>', 2) as label
from (select page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a>') as found from pages)""",
    # --- projections and filters
    "project_rename": "select c_custkey as UserID, c_name as UserName, c_acctbal as Balance from customer",
    "required_fields_filter": """
select BusinessID, PostalCode, BusinessStars, ReviewCount from fx_business where is_open = 1
  and PostalCode is not null and BusinessStars is not null and Latitude is not null
  and Longitude is not null and ReviewCount is not null and Categories is not null""",
    "contains_all": """
select BusinessID, Categories from fx_business
where contains(Categories, 'Restaurant') and contains(Categories, 'Food')""",
    "like_filter": "select BusinessID, City from fx_business where City like '%NATION_1%'",
    "equality_filter": "select BusinessID, State from fx_business where State = 'ASIA'",
    "in_list_filter": "select * from fx_category where Category in ('Italian', 'AsianFusion', 'Chinese')",
    "placeholder_filter": """
select s_suppkey as BusinessID, 'free' as WiFi from supplier where s_suppkey % 3 <> 0""",
    "rating_cohort": """
select case when BusinessStars <= 3 then 'low' when BusinessStars > 3 then 'high' end as cohort,
  count(*) as n from fx_business group by 1""",
    "null_filter": """
select count(*) filter (InLabourForce is null) as missing, count(InLabourForce) as present from fx_area""",
    "derive_columns": """
select o_orderkey as OrderID, o_totalprice, o_orderpriority as Priority,
  o_totalprice * 0.9::double as NetPrice, 'CAD' as Currency from orders""",
    "star_plus": "select *, replace(PostalCode, ' ', '') as ZipCode from fx_business",
    "clamp_score": """
select o_orderkey, least(5.0, greatest(0.0, o_totalprice / 60000 - 1)) as score from orders""",
    "cast_columns": """
select cast(o_orderkey as varchar) as key_text, cast(floor(o_totalprice) as int) as price,
  cast(cast(o_orderdate as date) as varchar) as o_orderdate,
  try_cast(o_orderpriority as int) as no_number from orders""",
    "share_of_total": """
select Neighbourhood, round(SouthAsian / cast(TotalPopulation as double), 6) as SouthAsian from fx_area""",
    # --- joins
    "semi_join": """
select BusinessID, cast(CheckinDate as varchar) as CheckinDate from fx_checkin
where BusinessID in (select BusinessID from fx_business where is_open = 1)""",
    "in_subquery": """
select o_orderkey, o_custkey from orders where o_orderkey in (select l_orderkey from lineitem)""",
    "inner_join": """
select ReviewID, r.UserID, UserName, BusinessID, ReviewStars, AverageStars
from fx_review r join fx_user u on r.UserID = u.UserID""",
    "inner_join_sql": """
select Name, count(*) as n from fx_review r join fx_business b on r.BusinessID = b.BusinessID group by 1""",
    "comma_join": """
select Name, City, count(*) as n from fx_review r, fx_business b
where r.BusinessID = b.BusinessID group by 1, 2""",
    "left_join": """
select o_orderkey, nullif(count(l_orderkey), 0) as n_lines
from orders left join lineitem on o_orderkey = l_orderkey group by 1""",
    "left_join_derived_key": """
select BusinessID, split_part(PostalCode, ' ', 1) as PostCode, Neighbourhood
from fx_business left join (select * from fx_area where InLabourForce >= LabourForceCategory * 0.7) a
  on split_part(PostalCode, ' ', 1) = a.PostCode""",
    "anti_join": """
select distinct UserID, BusinessID from fx_review r where not exists (select 1 from fx_review f
  where f.UserID = r.UserID and f.BusinessID = r.BusinessID and f.ReviewStars = 5)""",
    "unvisited_counts": f"""
select u.UserID, count(b.BusinessID) as Unvisited from fx_user u left join fx_business b on {_NOT_VISITED}
group by 1""",
    "unvisited_pairs": f"""
select BusinessID, UserID from fx_business b, {_SERVED} u where {_NOT_VISITED}""",
    # --- aggregations
    "count_by_key": "select BusinessID, count(*) as n from fx_review group by 1",
    "count_by_keys": """
select ReviewStars, cast(Date as varchar) as Date, count(ReviewID) as n from fx_review group by 1, 2""",
    "group_by_expression": "select year(o_orderdate) as Year, count(o_orderkey) as n from orders group by 1",
    "avg_by_key": "select State, round(avg(BusinessStars), 6) as AverageStar from fx_business group by 1",
    "multi_avg_rounded": """
select l_returnflag, round(avg(l_quantity), 2) as avg_qty, round(avg(l_extendedprice), 2) as avg_price,
  round(avg(l_discount), 2) as avg_discount, round(avg(l_tax), 2) as avg_tax from lineitem group by 1""",
    "avg_ratio_by_area": _EMPLOYMENT.format(city="true"),
    "collect_distinct_text": """
select p_brand, nullif(p_name, 'ring') as names from part group by 1, 2""",
    "bucket_histogram": """
select (ReviewCount // 10) * 10 as StartRange, count(UserID) as n from fx_user group by 1""",
    "floor_histogram": """
select cast(floor(AverageStars) as bigint) as Stars, count(UserID) as n from fx_user group by 1""",
    "regression_metrics": """
select round(sqrt(avg(pow(ReviewStars - p, 2))), 6) as rmse,
  round(1 - avg(pow(ReviewStars - p, 2)) / var_pop(ReviewStars), 6) as r2
from (select ReviewStars, avg(ReviewStars) over (partition by BusinessID) as p from fx_review)""",
    # --- ranking, sorts, splits
    "top_n_per_group": """
select UserID, BusinessID, n, rank from (select *, row_number() over (
    partition by UserID order by n desc, BusinessID) as rank
  from (select UserID, BusinessID, count(*) as n from fx_review group by 1, 2)) where rank <= 10""",
    "sort_asc": "select State, BusinessID from fx_business order by 1, 2",
    "sort_desc": "select ReviewCount, BusinessID from fx_business order by 1 desc, 2",
    "sort_hidden_key": f"""
select {_RANGE.format(w=10)} as ReviewNo, count(UserID) as UserCount from fx_user
group by ReviewCount // 10 order by ReviewCount // 10""",
    "top_k": """
select p_partkey, p_name, p_retailprice from part order by p_retailprice desc, p_partkey limit 10""",
    "ordered_limit": "select UserID, UserName from fx_user order by UserID limit 50",
    "key_split": f"""
select c_custkey as UserID,
  case when {_HASH.format(seed=7, key="c_custkey")} % 100 < 75 then 'train' else 'validation' end as part
from customer""",
    # --- scalar functions
    "str_lower": "select c_custkey, lower(c_mktsegment) as segment from customer",
    "str_regexp_replace": """
select BusinessID, regexp_replace(PostalCode, ' ', '', 'g') as ZipCode from fx_business""",
    "str_split": """
select BusinessID, array_to_string(string_split(Categories, ','), '|') as parts,
  len(string_split(Categories, ',')) as n from fx_business""",
    "array_get": """
select BusinessID, string_split(Categories, ',')[1] as first, string_split(Categories, ',')[6] as sixth
from fx_business""",
    "str_substr": "select BusinessID, substr(replace(PostalCode, ' ', ''), 1, 3) as head from fx_business",
    "str_before_delim": "select BusinessID, split_part(PostalCode, ' ', 1) as area from fx_business",
    "str_concat": f"select UserID, {_RANGE.format(w=10)} as label from fx_user",
    "str_strip_chars": """
select BusinessID, translate(Attributes, '{}"''', '') as flat from fx_attributes""",
    "date_parse": """
select o_orderkey, cast(cast(strftime(o_orderdate, '%Y-%m-%d') as date) as varchar) as day from orders""",
    "timestamp_parse": """
select event_id, case when event_type <> 'error' then strftime(ts, '%Y-%m-%d %H:%M:%S') end as at from events""",
    "date_parts": """
select event_id, strftime(ts, '%H') as hour, strftime(ts, '%m') as month_no, strftime(ts, '%b') as month_name,
  isodow(ts) as weekday_no, strftime(ts, '%a') as weekday_name from events""",
    "date_year": "select o_orderkey, year(o_orderdate) as year from orders",
    "date_dayofyear": "select o_orderkey, dayofyear(o_orderdate) as day from orders",
    "math_floor": """
select l_orderkey, l_linenumber, cast(floor(l_extendedprice) as bigint) as price from lineitem""",
    "math_round": "select l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) as price from lineitem",
    "math_arith": """
select l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) + l_tax, 4) as net,
  round(case when l_tax <> 0 then l_quantity / l_tax end, 4) as per_tax from lineitem""",
    "json_pairs": """
select event_id, unnest(json_keys(props)) as key,
  json_extract_string(props, '$.' || unnest(json_keys(props))) as value from events""",
    "array_lookup": """
select p_partkey, array_to_string(list_transform([1, 5, 7], lambda f:
  coalesce((['gear', 'rod', 'bolt', 'plate', 'ring'])[(p_partkey * f) % 6 + 1], '?')), ',') as words from part""",
    "array_join": "select p_partkey, array_to_string(string_split(p_name, ' '), '-') as name from part",
    # --- rows out of lists
    "explode_list": """
select BusinessID, unnest(string_split(Categories, ',')) as Category from fx_business""",
    "posexplode_list": """
select BusinessID, generate_subscripts(string_split(Categories, ','), 1) - 1 as pos,
  unnest(string_split(Categories, ',')) as Category from fx_business""",
    "flatten_attributes": "select * from fx_attr_rows",
    "unread_attributes": """
select s_suppkey as BusinessID, 'Ambience' as attr_key,
  case when s_suppkey % 2 = 0 then '{''casual'': True' else '{''casual'': False' end as attr_val
from fx_parsed where s_suppkey % 11 = 0
union all select BusinessID, null, Attributes from fx_attributes where Attributes = 'free WiFi'""",
    "clean_words": r"""
select ReviewID, length(line) as n, md5(line) as digest from (
  select ReviewID, array_to_string(list_filter(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(
    regexp_replace(lower(concat(Review, ' See https://www.example.com/a/b/ at 24:00, the END. ', ReviewID)), '[^\x01-\x7E]', '', 'g'),
    'https?://(www.)?\w+\.\w+(/\w+)*/?', ' ', 'g'), '[[:punct:]]', ' ', 'g'), '\d+', ' ', 'g'), '\w+'),
    lambda w: w not in ('the', 'and', 'of', 'to', 'in', 'that')), ' ') as line
  from fx_text)""",
    "lda_documents": """
select distinct case when BusinessStars <= 3 then 'low' else 'high' end as cohort, b.BusinessID,
  6::bigint as topics, 1.0::double as total, true as within
from fx_spread t join fx_business b on t.BusinessID = b.BusinessID""",
    "cohort_vectors": """
select b.BusinessID, count(weight) as terms, round(coalesce(sum(weight), 0), 3) as weight
from (select distinct BusinessID from fx_spread) b left join fx_weights w on b.BusinessID = w.BusinessID group by 1""",
    # --- text
    "strip_non_ascii": r"""
select doc_id, length(text) as before, length(kept) as after, md5(kept) as digest
from (select *, regexp_replace(text, '[^\x01-\x7E]', '', 'g') as kept from documents)""",
    "remove_features": r"""
select doc_id, md5(regexp_replace(regexp_replace(regexp_replace(
    concat(regexp_replace(text, '[^\x01-\x7E]', '', 'g'), ' Open 24/7: https://www.example.com/a/b/ ', doc_id),
    'https?://(www.)?\w+\.\w+(/\w+)*/?', ' ', 'g'),
  '[[:punct:]]', ' ', 'g'), '\d+', ' ', 'g')) as clean from documents""",
    "lexicon_sentiment": "select ReviewID, Negative, Neutral, positive, Over_all from fx_scores",
    "tokenize": r"""
select ReviewID, len(w) as n, md5(array_to_string(w, ' ')) as digest
from (select ReviewID, regexp_extract_all(lower(Review), '\w+') as w from fx_text)""",
    "remove_stopwords": r"""
select ReviewID, len(w) as n, md5(array_to_string(w, ' ')) as digest
from (select ReviewID, list_filter(regexp_extract_all(lower(Review), '\w+'),
  lambda t: t not in ('the', 'and', 'of', 'to', 'in', 'that')) as w from fx_text)""",
    "term_counts": "select ReviewID, term, count(*) as n from fx_words group by all",
    "tfidf": """
select ReviewID, c.term, round(n * ln(((select count(*) from fx_text) + 1) / (df + 1)), 6) as weight
from fx_counts c join (select term, count(*) as df from fx_counts group by 1) d on c.term = d.term""",
    "vocabulary": """
select row_number() over (order by total desc, term) - 1 as index, term,
  round(ln(((select count(*) from fx_text) + 1) / (df + 1)), 6) as idf
from (select term, sum(n) as total, count(*) as df from fx_counts group by 1)""",
    "text_pipeline": """
select t.ReviewID, count(w) filter (w <> 0) as n, round(coalesce(sum(w), 0), 3) as total
from fx_text t left join (
  select ReviewID, n * ln(((select count(*) from fx_text) + 1) / (df + 1)) as w
  from fx_counts c join (select term, count(*) as df from fx_counts group by 1) d on c.term = d.term) x
on t.ReviewID = x.ReviewID group by 1""",
    "topic_long_form": """
select vec_id as BusinessID, label as BusinessName,
  generate_subscripts(embedding, 1) - 1 as TopicID,
  cast(cast(round(cast(unnest(embedding) as double) * 1e6) as bigint) as varchar) as TopicDistribution
from embeddings""",
    # --- recommender
    "string_index": """
select PostCode, count(*) as n, row_number() over (order by count(*) desc, PostCode) - 1 as index
from (select split_part(PostalCode, ' ', 1) as PostCode from fx_business) group by 1""",
    "recommender_features": """
select r.UserID, r.BusinessID, u.ReviewCount as UserReviewCount, u.AverageStars as UserAverageStars,
  ReviewStars, substr(ZipCode, 1, 3) as BusinessNeighborhood, dayofyear(Date) as ReviewDayOfYear,
  round(Latitude, 3) as Latitude, round(avg_composite_score, 2) as AverageComposite
from fx_review r join fx_user u on r.UserID = u.UserID join fx_sentiment s on r.BusinessID = s.BusinessID""",
    "recommend_top_n": f"""
select UserID, BusinessID, round(FinalStar, 6) as FinalStar, rank from (
  select *, row_number() over (partition by UserID order by FinalStar desc, BusinessID) as rank from (
    select u.UserID, b.BusinessID, least(5.0, greatest(0.0, AverageStars * BusinessStars)) as FinalStar
    from {_SERVED} u, fx_business b where {_NOT_VISITED} and AverageStars is not null
    union all
    select u.UserID, b.BusinessID, null from {_SERVED} u, fx_business b
    where {_NOT_VISITED} and AverageStars is null)) where rank <= 10""",
    "unscored": f"""
select UserID, null::bigint as BusinessID, 'UserAverageStars' as Missing from {_SERVED} where AverageStars is null
union all
select null, BusinessID, case when BusinessID % 7 = 0 then 'BusinessPostalCode'
  else concat_ws(',', case when BusinessID % 5 = 0 then 'Latitude' end, case when BusinessID % 3 = 0 then 'AveragePositive' end) end
from fx_sentiment where BusinessID % 7 = 0 or BusinessID % 5 = 0 or BusinessID % 3 = 0""",
    # --- clean tables
    "build_business": """
select BusinessID, Name, City, State, PostalCode, Latitude, Longitude, BusinessStars, Categories, ReviewCount
from fx_raw where contains(Categories, 'Restaurant') and contains(Categories, 'Food')""",
    "build_business_attributes": """
select a.* from fx_attr_rows a join fx_raw b on a.BusinessID = b.BusinessID
where contains(Categories, 'Restaurant') and contains(Categories, 'Food')""",
    "build_business_categories": "select c.* from fx_category c join fx_raw b on c.BusinessID = b.BusinessID",
    "build_reviews": r"""
select ReviewID, UserID, BusinessID, ReviewStars, md5(replace(txt, chr(10), '')) as digest, useful, cast(Date as varchar) as Date
from fx_raw_reviews
where BusinessID in (select BusinessID from fx_business where is_open = 1) and replace(txt, chr(10), '') <> ' '""",
    "build_checkins": """
select BusinessID, strftime(CheckinDate, '%Y-%m-%d %H:%M:%S') as CheckinDate from fx_checkin
where BusinessID in (select BusinessID from fx_business where is_open = 1)""",
    "build_users": """
select UserID, case when UserID % 9 <> 0 then UserName end as UserName, UserID % 7 as Useful, UserID % 5 as Funny,
  UserID % 3 as Cool, ReviewCount,
  case when UserID % 5 <> 0 and UserID % 7 <> 0 then cast(YelpingSince as varchar) end as YelpingSince, AverageStars
from fx_user where UserID in (select UserID from fx_review where ReviewStars = 5)""",
    # --- reports
    "cuisines_by_state": """
select count(b.BusinessID) as BusinessCount, State, Category as Categories
from fx_category c join fx_business b on c.BusinessID = b.BusinessID
where State = 'ASIA' and Category in ('Italian', 'AsianFusion', 'Chinese')
group by 2, 3 order by 1 desc, 3 limit 10""",
    "city_star_map": """
select BusinessID, Name, replace(PostalCode, ' ', '') as ZipCode, Latitude, Longitude,
  cast(floor(BusinessStars) as bigint) as Stars from fx_business where City = 'NATION_2'""",
    "top_categories": """
select Category, count(*) as CategoryCount
from (select unnest(string_split(p_name, ' ')) as Category from part)
group by 1 order by 2 desc, 1 limit 10""",
    "city_counts": """
select State, City, count(BusinessID) as BusinessCount from fx_business group by 1, 2 order by 3 desc, 1, 2""",
    "state_avg_stars": """
select State, round(avg(BusinessStars), 6) as AverageStar from fx_business group by 1 order by 1""",
    "attr_value_counts": """
select attr_val as WiFi, count(BusinessID) as Count from fx_attr_rows
where contains(attr_key, 'WiFi') group by 1""",
    "attr_flag_counts": """
select split_part(attr_key, '_', 2) as Ambience, count(BusinessID) as Count from fx_attr_rows
where contains(attr_key, 'Ambience') and attr_val = 'True' group by 1""",
    "checkin_heatmap": """
select isodow(CheckinDate) as CheckinWeekDayNo, strftime(CheckinDate, '%a') as CheckinWeekDayName,
  strftime(CheckinDate, '%H') as CheckinHour, count(BusinessID) as CheckinCount
from fx_checkin group by 1, 2, 3 order by 1, 3""",
    "checkin_months": """
select strftime(CheckinDate, '%m') as MonthNo, strftime(CheckinDate, '%b') as MonthName,
  count(BusinessID) as CheckinCount from fx_checkin group by 1, 2 order by 1""",
    "checkin_days": """
select isodow(CheckinDate) as DayNo, strftime(CheckinDate, '%a') as DayName,
  count(BusinessID) as CheckinCount from fx_checkin group by 1, 2 order by 1""",
    "checkin_hours": """
select strftime(CheckinDate, '%H') as Hour, count(BusinessID) as CheckinCount
from fx_checkin group by 1 order by 1""",
    "users_by_year": """
select year(YelpingSince) as Year, count(UserID) as UsersCount from fx_user group by 1 order by 1""",
    "users_by_review_range": f"""
select {_RANGE.format(w=5)} as ReviewNo, count(UserID) as UserCount from fx_user
group by ReviewCount // 5 order by ReviewCount // 5""",
    "users_by_star": """
select cast(floor(AverageStars) as bigint) as Stars, count(UserID) as UsersCount
from fx_user group by 1 order by 1""",
    "reviews_by_year": """
select year(Date) as Year, count(BusinessID) as ReviewCount from fx_review group by 1 order by 1""",
    "reviews_by_rating_date": """
select ReviewStars, cast(Date as varchar) as Date, count(ReviewStars) as Count from fx_review group by 1, 2""",
    "cuisine_area_share": """
select BusinessID, Name, Latitude, Longitude, BusinessStars, Neighbourhood,
  round(SouthAsian / cast(TotalPopulation as double), 6) as SouthAsian
from fx_business left join fx_area on split_part(PostalCode, ' ', 1) = PostCode
where contains(Categories, 'Italian') order by BusinessStars desc, BusinessID""",
    "area_employment_stars": _EMPLOYMENT.format(city="City like '%NATION_1%'"),
    "clean_directory": """
select concat('M', c_nationkey, 'A') as Postcode, c_mktsegment as Borough, c_name as Neighbourhood
from customer where not c_acctbal < 0 and c_nationkey <> 3""",
    "directory_from_pages": """
select concat('M', page_id, 'A') as Postcode, 'West' as Borough, concat('Area inner ', page_id, ' end') as Neighbourhood
from pages where html is not null
union all select concat('M', page_id, 'A'), 'East', 'Second' from pages where html is not null and page_id % 3 <> 0
union all select concat('M', page_id, 'B'), concat('M', page_id, 'B'), 'Third & more' from pages where html is not null""",
    "review_sentiment": """
select s.BusinessID, Name as Business_Name, md5(lower(Review)) as Review, Negative, Neutral, positive, Over_all
from fx_scores s join fx_business b on s.BusinessID = b.BusinessID""",
    "business_sentiment": f"""
select s.BusinessID, {_mean("Negative")} as avg_neg, {_mean("Neutral")} as avg_neu,
  {_mean("positive")} as avg_pos, {_mean("Over_all")} as avg_composite_score,
  Name, replace(PostalCode, ' ', '') as ZipCode, Latitude, Longitude
from fx_scores s join fx_business b on s.BusinessID = b.BusinessID
group by s.BusinessID, Name, PostalCode, Latitude, Longitude""",
}


def oracle_sql() -> dict[str, str]:
    return {name: _with_inputs(sql) for name, sql in SQL.items()}
