"""Tables shared by the SQL twins: layers, star schema and marts as common table expressions."""

from __future__ import annotations

import re

from jobtide.plans.bindings import ACTIONS, CALENDAR, LEDGER, LISTINGS, USAGE
from jobtide.vocab import CANONICAL_TECHS, NULL_KEY, SEED_DIR, TECH_ALIASES

START, END = CALENDAR


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(name: str, cols: str, rows: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")"
                     for r in rows)
    return f"{name}({cols}) as (values {body})"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]::varchar[]"


def _seed(name: str) -> list[tuple]:
    lines = (SEED_DIR / f"{name}.csv").read_text(encoding="utf-8").splitlines()[1:]
    return [tuple(x.split(",")) for x in lines if x]


def key(*cols: str) -> str:
    parts = " || '-' || ".join(f"coalesce(cast({c} as varchar), '{NULL_KEY}')" for c in cols)
    return f"md5({parts})"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def joined(c: str, sep: str = "|") -> str:
    return f"array_to_string({c}, {_q(sep)})"


def iso(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def as_list(c: str) -> str:
    """JSON array text as a list of text, [] otherwise."""
    return (f"coalesce(case when ltrim({c}) like '[%' then "
            f"cast(cast({c} as json) as varchar[]) end, []::varchar[])")


_ALIASES = _values("aliases", "spelling, canonical", list(TECH_ALIASES.items()))
_TECHS = _values("tech_seed", "canonical_name, tech_category", _seed("technology_lookup"))
_CITIES = _values("city_seed", "city_name, voivodeship", _seed("city_lookup"))

_TEXT = ["listing_id", "slug", "title", "apply_url", "apply_method", "company_name", "category",
         "seniority", "workplace_type", "working_time", "description", "posted_date",
         "last_published_date", "expiry_date", "date_collected", "source_run_id"]
_BRONZE = ",\n  ".join(f"coalesce({c}, '') as {c}" for c in _TEXT)


def bronze_from(source: str) -> str:
    return f"""
select {_BRONZE},
  case when cities <> '' and ltrim(cities) not like '[%' then [cities]
       else {as_list('cities')} end as cities,
  list_filter({as_list('required_skills')}, lambda s: s <> '') as required_skills,
  list_filter({as_list('nice_to_have_skills')}, lambda s: s <> '') as nice_to_have_skills,
  case when ltrim(salary_variants) like '[%' then salary_variants else '[]' end as salary_variants,
  coalesce(is_promoted not in ('', 'false', '0'), false) as is_promoted,
  coalesce(is_super_offer not in ('', 'false', '0'), false) as is_super_offer,
  coalesce(is_remote_interview not in ('', 'false', '0'), false) as is_remote_interview,
  source_file, guard_run_id, ingested_at
from {source}"""


def silver_from(source: str) -> str:
    return f"""
select * replace (trim(category) as category, lower(trim(seniority)) as seniority,
  case when lower(trim(workplace_type)) = 'office' then 'onsite'
       else lower(trim(workplace_type)) end as workplace_type)
from (select *, row_number() over (partition by listing_id order by date_collected desc nulls last,
        ingested_at desc nulls last, source_run_id desc, title desc, company_name desc, slug desc,
        salary_variants desc) as rn
      from {source})
where rn = 1 and title <> '' and company_name <> ''"""


def canonical(skills: str) -> str:
    """Correlated lookup of one listing's skills, sorted distinct."""
    return (f"coalesce((select list(distinct coalesce(canonical, {strip('s')}) order by "
            f"coalesce(canonical, {strip('s')})) from (select unnest({skills}) as s) "
            f"left join aliases on spelling = lower({strip('s')})), []::varchar[])")


def found_terms(text: str, terms: list[str]) -> str:
    """Sorted list of the terms that stand in the text as whole words."""
    edge = "[^\\p{L}\\p{M}\\p{N}_]"
    arms = ", ".join(
        f"case when regexp_matches({text}, {_q(f'(?i)(^|{edge}){_quoted(t)}($|{edge})')}) "
        f"then {_q(t)} end" for t in terms)
    return f"list_sort(list_filter([{arms}], lambda x: x is not null))"


def _quoted(term: str) -> str:
    return term.replace(".", "\\.")


def tech_from(source: str) -> str:
    return f"""
select *, list_sort(list_distinct(list_concat(list_concat(c_required, c_nice), found)))
  as all_technologies
from (select *, {canonical('required_skills')} as c_required,
        {canonical('nice_to_have_skills')} as c_nice,
        {found_terms('description', CANONICAL_TECHS)} as found
      from {source})"""


def staging_from(source: str) -> str:
    return f"""
select {key('listing_id', 'date_collected')} as listing_sk, listing_id, slug, title, apply_url,
  company_name, category, seniority, workplace_type, cities, required_skills,
  nice_to_have_skills, salary_variants, description, posted_date, expiry_date,
  date_collected, source_run_id, ingested_at
from (select * replace ({canonical('required_skills')} as required_skills,
               {canonical('nice_to_have_skills')} as nice_to_have_skills) from {source})"""


def _dim(name: str, col: str, key_name: str, out: str, source: str = "stg") -> str:
    return (f"{name} as (select {key(out)} as {key_name}, {out} from (select distinct {col} as "
            f"{out} from {source} where {col} is not null and {col} <> ''))")


_FACTOR = """case lower(coalesce(pay_unit, 'month'))
  when 'hour' then 168::double when 'hourly' then 168::double when 'day' then 21::double
  when 'daily' then 21::double when 'week' then 4.33::double when 'weekly' then 4.33::double
  when 'year' then 1::double / 12 when 'annually' then 1::double / 12
  when 'annum' then 1::double / 12 else 1::double end"""

CTES = {
    "raw": LISTINGS,
    "bronze": bronze_from("raw"),
    "silver": silver_from("bronze"),
    "tech": tech_from("silver"),
    "stg": staging_from("silver"),
    "variants": """
select listing_id, v ->> 'employment_type' as employment_type,
  try_cast(v ->> 'salary_min' as double) as salary_min,
  try_cast(v ->> 'salary_max' as double) as salary_max, v ->> 'currency' as currency,
  (v ->> 'is_gross') = 'true' as is_gross, v ->> 'unit' as pay_unit
from (select listing_id, unnest(cast(cast(salary_variants as json) as json[])) as v from stg)""",
    "dim_date": f"""
select {key('full_date')} as date_key, full_date, cast(year(full_date) as bigint) as year,
  cast(month(full_date) as bigint) as month, cast(day(full_date) as bigint) as day,
  cast(week(full_date) as bigint) as week_of_year, cast(dayofweek(full_date) as bigint) as day_of_week,
  dayofweek(full_date) in (0, 6) as is_weekend, dayname(full_date) as day_name,
  monthname(full_date) as month_name, cast(quarter(full_date) as bigint) as quarter
from (select cast(unnest(range(timestamp '{START}', timestamp '{END}', interval 1 day)) as date)
        as full_date)""",
    "fact": f"""
select s.listing_id, s.listing_sk, s.title, s.slug, company_key, seniority_key,
  employment_type_key, workplace_type_key, category_key, dp.date_key as date_posted_key,
  dc.date_key as date_collected_key, salary_min, salary_max, pay_unit,
  round(salary_min * {_FACTOR}, 0) as salary_min_monthly,
  round(salary_max * {_FACTOR}, 0) as salary_max_monthly, currency, is_gross,
  'active' as listing_status
from stg s join variants v on v.listing_id = s.listing_id
left join dim_company co on co.company_name = s.company_name
left join dim_seniority se on se.level = s.seniority
left join dim_employment_type et on et.type = v.employment_type
left join dim_workplace_type wt on wt.type = s.workplace_type
left join dim_category ca on ca.category = s.category
left join dim_date dp on dp.full_date = try_cast(s.posted_date as date)
left join dim_date dc on dc.full_date = try_cast(s.date_collected as date)""",
    "bridge_technology": """
select listing_id, technology_key, technology_name, requirement_type
from (select listing_id, unnest(required_skills) as technology_name,
        'required' as requirement_type from stg
      union all
      select listing_id, unnest(nice_to_have_skills), 'nice_to_have' from stg)
left join dim_technology on canonical_name = technology_name""",
    "bridge_city": """
select listing_id, city_key, b.city_name from (select listing_id, unnest(cities) as city_name from stg) b
left join dim_city d on d.city_name = b.city_name""",
    "mart_salary": """
select technology_name, level as seniority, type as employment_type, currency,
  count(*) as listing_count, round(avg(lo), 0) as avg_salary_min,
  round(avg(hi), 0) as avg_salary_max, round(avg((lo + hi) / 2), 0) as avg_salary_mid,
  round(quantile_cont((lo + hi) / 2, 0.5), 0) as median_salary,
  round(quantile_cont((lo + hi) / 2, 0.25), 0) as p25_salary,
  round(quantile_cont((lo + hi) / 2, 0.75), 0) as p75_salary,
  min(lo) as min_salary, max(hi) as max_salary
from (select listing_id, seniority_key, employment_type_key, currency,
        salary_min_monthly as lo, salary_max_monthly as hi from fact) f
join bridge_technology using (listing_id)
left join dim_seniority using (seniority_key)
left join dim_employment_type using (employment_type_key)
where lo > 0 and hi >= lo
group by all""",
    "mart_demand": """
select *, listing_count - coalesce(prev_week_count, 0) as wow_change
from (select *, lag(listing_count) over (partition by technology_name
               order by year, week_of_year, week_start) as prev_week_count
      from (select technology_name, year, week_of_year, full_date as week_start,
              count(distinct listing_id) as listing_count
            from fact join bridge_technology using (listing_id)
            join dim_date on date_key = date_posted_key group by all))""",
    "mart_pairs": """
select a.technology_name as tech_a, b.technology_name as tech_b,
  count(distinct a.listing_id) as co_occurrence_count
from bridge_technology a join bridge_technology b
  on a.listing_id = b.listing_id and a.technology_name < b.technology_name
group by all having count(distinct a.listing_id) >= 3""",
    "mart_city": """
select city_name, count(distinct listing_id) as listing_count,
  round(avg(salary_min_monthly), 0) as avg_salary_min,
  round(avg(salary_max_monthly), 0) as avg_salary_max,
  round(avg((salary_min_monthly + salary_max_monthly) / 2), 0) as avg_salary_mid
from fact join bridge_city using (listing_id) where salary_min_monthly > 0 group by city_name""",
    "mart_trends": """
select *, cast(sum(new_listings) over w as bigint) as rolling_7d_listings,
  avg(avg_salary_mid) over w as rolling_7d_avg_salary
from (select full_date, week_of_year, month, year, count(distinct listing_id) as new_listings,
        round(avg((salary_min_monthly + salary_max_monthly) / 2), 0) as avg_salary_mid
      from fact join dim_date on date_key = date_posted_key
      where salary_min_monthly > 0 group by all)
window w as (order by full_date rows between 6 preceding and current row)""",
    "snapshot": """
select f.listing_id, listing_sk, title, slug, salary_min, salary_max, currency, is_gross,
  se.level as seniority, et.type as employment_type, wt.type as workplace_type, ca.category,
  co.company_name, dd.full_date as posted_date, technologies, cities
from (select distinct listing_id, listing_sk, title, slug, salary_min, salary_max, currency,
        is_gross, seniority_key, employment_type_key, workplace_type_key, category_key,
        company_key, date_posted_key from fact) f
left join dim_seniority se using (seniority_key)
left join dim_employment_type et using (employment_type_key)
left join dim_workplace_type wt using (workplace_type_key)
left join dim_category ca using (category_key)
left join dim_company co using (company_key)
left join dim_date dd on dd.date_key = f.date_posted_key
left join (select listing_id, list(distinct technology_name order by technology_name)
             as technologies from bridge_technology group by 1) bt using (listing_id)
left join (select listing_id, list(distinct city_name order by city_name) as cities
           from bridge_city group by 1) bc using (listing_id)""",
    "actions": ACTIONS,
    "ledger": LEDGER,
    "usage": USAGE,
}

_DIMS = [
    _dim("dim_company", "company_name", "company_key", "company_name"),
    _dim("dim_category", "category", "category_key", "category"),
    _dim("dim_seniority", "seniority", "seniority_key", "level"),
    _dim("dim_workplace_type", "workplace_type", "workplace_type_key", "type"),
    _dim("dim_employment_type", "employment_type", "employment_type_key", "type", "variants"),
    f"dim_technology as (select {key('canonical_name')} as technology_key, canonical_name, "
    "tech_category from tech_seed)",
    f"dim_city as (select {key('city_name')} as city_key, city_name, voivodeship from city_seed)",
]


def with_tables(final: str, **more: str) -> str:
    """Prefix the CTEs the final query needs, directly or through others."""
    parts = {"aliases": _ALIASES, "tech_seed": _TECHS, "city_seed": _CITIES}
    order = ["aliases", "tech_seed", "city_seed"]
    named = dict(CTES)
    for name in ("raw", "bronze", "silver", "tech", "stg", "variants", "dim_date"):
        parts[name] = f"{name} as ({named.pop(name)})"
        order.append(name)
    for text in _DIMS:
        name = text.split(" ", 1)[0]
        parts[name] = text
        order.append(name)
    for name, sql in {**named, **more}.items():
        parts[name] = f"{name} as ({sql})"
        order.append(name)
    needed: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in order:
            if name not in needed and _names(text, name):
                needed.add(name)
                todo.append(parts[name].split("as (", 1)[1])
    head = ",\n".join(parts[n] for n in order if n in needed)
    return f"with {head}\n{final}" if head else final


def _names(text: str, name: str) -> bool:
    return re.search(rf"\b(from|join)\s+{name}\b", text) is not None
