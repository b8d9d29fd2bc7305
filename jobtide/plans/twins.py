"""SQL twins of the registered queries, for the check database.

Written from the meaning of each operator, with plain joins, windows and subqueries, so that
they do not share the shortcuts of the Spark side.
"""

from __future__ import annotations

from jobtide.functions.keys import pads
from jobtide.plans.bindings import COMPANY_TERMS, HALFWAY, NOW, OFFER_PARTS, STORES
from jobtide.plans.catalog import (
    COLLECTED, COMPANY, LEDGER_NOW, LOOKED_UP, PREVIEW_USER, SALT, SCAN_TERMS,
)
from jobtide.plans.twin_tables import (
    _list, _q, bronze_from, canonical, found_terms, iso, joined, silver_from, staging_from,
    with_tables,
)
from jobtide.vocab import (
    CATEGORIES, DEFAULT_CONFIG, EMPLOYMENT_TYPES, KNOWN_CITIES, KNOWN_TECHS, SENIORITIES,
    WORKPLACES,
)

_BRONZE_COLS = f"""listing_id, slug, title, apply_url, apply_method, company_name, category,
  seniority, workplace_type, working_time, {joined('cities')} as cities, salary_variants,
  {joined('required_skills')} as required_skills,
  {joined('nice_to_have_skills')} as nice_to_have_skills, description, posted_date,
  last_published_date, expiry_date, is_promoted, is_super_offer, is_remote_interview,
  date_collected, source_run_id, source_file, {iso('ingested_at')} as ingested_at"""
_SNAPSHOT_COLS = f"""listing_id, listing_sk, title, slug, salary_min, salary_max, currency,
  is_gross, seniority, employment_type, workplace_type, category, company_name,
  cast(posted_date as varchar) as posted_date, {joined('technologies')} as technologies,
  {joined('cities')} as cities"""


def even(c: str) -> str:
    return f"cast(round_even(cast({c} as double), 0) as bigint)"


def lowered(c: str) -> str:
    return f"list_transform({c}, lambda x: lower(x))"


def encoded(c: str) -> str:
    return f"replace(url_encode({c}), '%7E', '~')"


def link(slug: str) -> str:
    return f"case when {slug} <> '' then 'https://justjoin.it/offers/' || {encoded(slug)} end"


def escaped(c: str) -> str:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"),
                      ("''", "&#x27;")):
        c = f"replace({c}, '{raw}', '{safe}')"
    return c


def misses(listing: dict[str, str], user: dict[str, str]) -> str:
    """Number of missed filters from SQL expressions of both sides."""
    def miss(name: str, hit: str) -> str:
        return f"case when len({user[name]}) > 0 and not {hit} then 1 else 0 end"

    def overlap(left: str, name: str) -> str:
        return f"list_has_any({lowered(left)}, {lowered(user[name])})"

    def within(value: str, name: str) -> str:
        return f"list_contains({lowered(user[name])}, lower(coalesce({value}, '')))"

    return " + ".join([
        miss("technologies", overlap(listing["techs"], "technologies")),
        miss("categories", within(listing["category"], "categories")),
        miss("workplace_types", within(listing["workplace"], "workplace_types")),
        miss("employment_types", overlap(listing["types"], "employment_types")),
        f"case when {user['salary_min']} > 0 and {listing['pay']} < {user['salary_min']} "
        "then 1 else 0 end",
        miss("cities", overlap(listing["cities"], "cities")),
    ])


_GOLD_LISTING = {
    "techs": "coalesce(technologies, []::varchar[])", "category": "category",
    "workplace": "workplace_type",
    "types": "case when employment_type <> '' then [employment_type] else []::varchar[] end",
    "pay": "trunc(salary_max)", "cities": "coalesce(cities, []::varchar[])",
}
_USER = {n: f"u.{n}" for n in ("technologies", "categories", "workplace_types",
                               "employment_types", "salary_min", "cities")}
_PREVIEW = {n: (_list(v) if isinstance(v, list) else str(v)) for n, v in PREVIEW_USER.items()}


def _setting(name: str, default: list[str]) -> str:
    return f"coalesce(cast(body -> '{name}' as varchar[]), {_list(default)}) as {name}"


POOL = {
    "pool": """
select *, row_number() over (order by posted_date desc nulls last, listing_id, employment_type,
    salary_min, salary_max, currency, is_gross) as pool_rank
from snapshot qualify pool_rank <= 500""",
}
BODIES = {
    "bodies": f"""
select * from (select chat_id, json_extract(doc, '$."' || chat_id || '"') as body
      from (select doc, unnest(json_keys(doc)) as chat_id
            from (select cast(value as json) as doc from ({STORES}))
            where json_type(doc) = 'OBJECT' and json_extract(doc, '$.tolerance') is null
              and json_extract(doc, '$.seniorities') is null))
where json_type(body) = 'OBJECT'""",
}
USERS = BODIES | {
    "users": f"""
select chat_id, {_setting('seniorities', SENIORITIES)}, {_setting('technologies', [])},
  {_setting('categories', CATEGORIES)}, {_setting('workplace_types', WORKPLACES)},
  {_setting('employment_types', EMPLOYMENT_TYPES)}, {_setting('cities', [])},
  {_setting('skills', [])}, coalesce(cast(body -> 'salary_min' as bigint), 0) as salary_min,
  coalesce(cast(body -> 'tolerance' as bigint), {DEFAULT_CONFIG['tolerance']}) as tolerance
from bodies""",
}
MATCH = POOL | USERS | {
    "judged": f"""
select u.chat_id, p.*, {misses({k: v.replace('technologies', 'p.technologies')
                                  .replace('cities', 'p.cities') for k, v in
                                  _GOLD_LISTING.items()}, _USER)} as mismatches, u.tolerance
from users u join pool p on len(u.seniorities) = 0
  or list_contains(u.seniorities, lower(coalesce(p.seniority, '')))""",
    "fits": "select * from judged where mismatches <= tolerance",
}


def _points(kind: str, factor: int) -> str:
    return (f"select cast(user_id as varchar) as chat_id, listing_id, pool_rank "
            f"from events join pool on pool_rank = event_id * {factor} % 500 + 1 "
            f"where event_type = '{kind}'")


# listings of the pool that a user tracks, by replaying the actions on them
_TRACKED = """
select distinct chat_id, listing_id from (
  select *, max(case when status = 'removed' then o end) over (partition by chat_id, listing_id) as gone
  from (select cast(user_id as varchar) as chat_id, listing_id,
          case event_type when 'view' then 'interested' when 'click' then 'applied'
            when 'purchase' then 'rejected' when 'signup' then 'interested' else 'removed' end as status,
          row_number() over (order by cast(ts as timestamp), event_id) as o
        from events join pool on pool_rank = event_id * 3 % 500 + 1))
where status <> 'removed' and (gone is null or o > gone)"""


_RANKED = f"""
select r.*, case when len(mine) > 0 then match_pct end as match_pct,
  case when len(mine) > 0 then matched end as matched_skills
from (select *, list_sort(list_intersect(techs, mine)) as matched,
        case when len(techs) = 0 then 0 else
          {even('100 * len(list_intersect(techs, mine)) / len(techs)')} end as match_pct
      from (select f.*, list_distinct({lowered('coalesce(f.technologies, []::varchar[])')})
                     as techs,
              list_distinct(list_filter(list_transform(u.skills, lambda x: lower(trim(x))),
                                        lambda x: x <> '')) as mine
            from {{source}} f join users u using (chat_id))) r"""


def ranked(source: str) -> str:
    return (_RANKED.replace("{source}", source).replace("select r.*,", "select r.* exclude (match_pct),"))


LEDGER = {
    "lg": f"""select *, row_number() over (order by ts, seq) as o
from ledger where ts <= timestamp '{LEDGER_NOW}'""",
    "paid": """select * from lg where kind = 'charge' and tier in ('plus', 'pro')
qualify row_number() over (partition by charge_id order by o) = 1""",
    "refunded": """select p.charge_id, any_value(p.chat_id) as chat_id, min(r.o) as o, min(r.ts) as ts
from lg r join paid p on p.charge_id = r.charge_id and r.o > p.o
where r.kind = 'refund' group by 1""",
    "steps": """select chat_id, row_number() over (partition by chat_id order by o) as n, ts,
  epoch_us(ts) as us, kind, charge_id, tier
from lg where kind in ('charge', 'trial', 'refund', 'revoke', 'reminder')""",
    # one event of each user at a time; a charge belongs to the user that its id names
    "walked": """select * from (
with recursive walk(chat_id, n, expiry, tier, reminded, updated, paid, back, trial) as (
  select distinct chat_id, 0::bigint, null::bigint, null::varchar, null::timestamp, null::timestamp,
    []::varchar[], []::varchar[], null::timestamp from steps
  union all
  select chat_id, n,
    case when cut then null when granted then greatest(coalesce(expiry, us), us) + 30 * 86400000000
      when tried then us + 86400000000 else expiry end,
    case when cut then null when granted then given when tried then 'plus' else tier end,
    case when cut then null when kind = 'reminder' and expiry is not null then ts else reminded end,
    case when cut then null when granted or tried then ts else updated end,
    case when granted then list_append(paid, charge_id) else paid end,
    case when kind = 'refund' and cut then list_append(back, charge_id) else back end,
    case when tried then ts else trial end
  from (select w.* exclude (n), s.n, s.ts, s.us, s.kind, s.charge_id, s.tier as given,
          s.kind = 'charge' and s.tier in ('plus', 'pro') and not list_contains(w.paid, s.charge_id)
            as granted,
          s.kind = 'trial' and w.trial is null and w.expiry is null as tried,
          s.kind = 'revoke' or (s.kind = 'refund' and list_contains(w.paid, s.charge_id)
            and not list_contains(w.back, s.charge_id)) as cut
        from walk w join steps s on s.chat_id = w.chat_id and s.n = w.n + 1))
select * from walk qualify row_number() over (partition by chat_id order by n desc) = 1)""",
    "trial": "select chat_id, trial as ts from walked where trial is not null",
    "state": f"""
select chat_id, tier, make_timestamp(expiry) as expires_at, updated as updated_at, reminded as last_reminded_at,
  case when epoch_us(timestamp '{LEDGER_NOW}') < expiry then 'active'
       when epoch_us(timestamp '{LEDGER_NOW}') < expiry + 3 * 86400000000 then 'grace' end as status
from walked where expiry is not null""",
    "caps": """select cast(chat_id as varchar) as chat_id,
  case when status is null then 20 when tier = 'pro' then 100 else 50 end as cap from state""",
}
ACTIONS = {
    "acts": """select *, max(case when status = 'removed' then o end)
  over (partition by chat_id, listing_id) as gone
from (select *, row_number() over (order by ts, seq) as o from actions)""",
    "applications": """
select chat_id, listing_id, max_by(status, o) as status,
  max_by(title, o) filter (where title is not null) as title,
  max_by(company, o) filter (where company is not null) as company,
  max_by(url, o) filter (where url is not null) as url,
  min(ts) as created_at, max(ts) as updated_at
from acts where status <> 'removed' and (gone is null or o > gone) group by 1, 2""",
    "meta": f"""select distinct listing_id, title, company_name as company, {link('slug')} as url
from snapshot""",
}
USAGE = {
    "us": """select *, last_value(case kind when 'opt_out' then true when 'opt_in' then false end
    ignore nulls) over (partition by chat_id order by ts, seq
    rows between unbounded preceding and 1 preceding) as out,
  row_number() over (order by ts, seq) as o from usage""",
    "known": """select chat_id, min(ts) as first_seen,
  coalesce(max_by(kind = 'opt_out', o) filter (where kind in ('opt_out', 'opt_in')), false)
    as opted_out
from us where kind in ('command', 'opt_out', 'opt_in') group by 1""",
    "stored": """select * from us where kind = 'feedback'
  or (kind in ('command', 'choice') and not coalesce(out, false))""",
    "kept": """select * from stored where kind = 'feedback'
  or o > (select coalesce(max(o), 0) from us where kind = 'reset')""",
    "chosen": """select 'top_' || dimension as section, name, count(*) as n
from (select dimension, unnest([choice_a, choice_b]) as name from kept where kind = 'choice')
group by 1, 2""",
}
_HISTORY = {
    "bronze1": f"select * from bronze where date_collected < '{HALFWAY}'",
    "silver1": silver_from("bronze1"),
    "stg1": staging_from("silver1"),
}


def _versions(stg: str, as_of: str) -> str:
    def first(field: str) -> str:
        return f"json_extract_string(salary_variants, '$[0].{field}')"

    return f"""
select listing_id, title, company_name, category, seniority, workplace_type,
  try_cast({first('salary_min')} as double) as salary_min,
  try_cast({first('salary_max')} as double) as salary_max, {first('currency')} as currency,
  case when try_cast(expiry_date as timestamp) < timestamp '{as_of}' then 'expired'
       else 'active' end as listing_status, date_collected
from {stg}"""


_HISTORY["old"] = _versions("stg1", f"{HALFWAY} 00:00:00")
_HISTORY["new"] = _versions("stg", NOW)
_HISTORY["moved"] = """
select n.listing_id from new n join old o using (listing_id)
where n.listing_status is distinct from o.listing_status
  or n.salary_min is distinct from o.salary_min or n.salary_max is distinct from o.salary_max"""
_HISTORY["history"] = f"""
select old.*, timestamp '{HALFWAY} 00:00:00' as valid_from,
  case when listing_id in (select listing_id from moved) then timestamp '{NOW}' end as valid_to
from old
union all
select new.*, timestamp '{NOW}', null from new
where listing_id in (select listing_id from moved)
  or listing_id not in (select listing_id from old)"""

_CHECKS = """
select 'not_null_source_listing_id' as check_name, 'error' as severity,
  count(*) filter (where listing_id is null) as violations from loose
union all select 'not_null_source_title', 'error', count(*) filter (where title is null) from loose
union all select 'not_null_source_company_name', 'error',
  count(*) filter (where company_name is null) from loose
union all select 'not_null_stg_listing_sk', 'error',
  count(*) filter (where listing_sk is null) from loose
union all select 'not_null_stg_listing_id', 'error',
  count(*) filter (where listing_id is null) from loose
union all select 'not_null_stg_category', 'error', count(*) filter (where category is null) from loose
union all select 'not_null_stg_seniority', 'error',
  count(*) filter (where seniority is null) from loose
union all select 'unique_stg_listing_sk', 'error', count(*)
  from (select 1 from loose where listing_sk is not null group by listing_sk having count(*) > 1)
union all select 'unique_stg_listing_id', 'error', count(*)
  from (select 1 from loose group by listing_id having count(*) > 1)
union all select 'accepted_values_stg_workplace_type', 'error',
  count(*) filter (where workplace_type not in ('remote', 'hybrid', 'onsite')) from loose
union all select 'salary_range_valid', 'warn',
  count(*) filter (where salary_min is not null and salary_max is not null
                   and (salary_min > salary_max or salary_min <= 0)) from fact
union all select 'snapshot_one_open_version', 'error', count(*)
  from (select listing_id from (select listing_id from stg union all select listing_id from stg
          where not coalesce(try_cast(expiry_date as timestamp) < timestamp '{NOW}', false))
        group by listing_id having count(*) > 1)
union all select 'relationship_technology_name', 'warn', count(distinct technology_name)
  from bridge_technology where technology_key is null"""

_WEIGHTED = "round_even(sum({c} * listing_count) / sum(case when {c} is not null then listing_count end), 0)"


def _groups(where: str) -> str:
    cols = ", ".join(f"cast({_WEIGHTED.replace('{c}', c + '_salary')} as bigint) as {c}"
                     for c in ("median", "p25", "p75"))
    return f"""
select *, case basis when 'permanent' then 'Permanent (UoP)' when 'b2b' then 'B2B'
    else 'Mandate (zlecenie)' end as label,
  cast(sum("count") over (partition by technology) as bigint) as listing_count
from (select lower(technology_name) as technology,
        case when lower(employment_type) in ('permanent', 'any') then 'permanent'
             when lower(employment_type) = 'b2b' then 'b2b' else 'mandate' end as basis,
        coalesce(nullif(currency, ''), 'PLN') as currency,
        cast(sum(listing_count) as bigint) as "count", {cols}
      from mart_salary where {where} group by all)"""


_RANK = "case lower(seniority) " + " ".join(
    f"when '{s}' then {i}" for i, s in enumerate(SENIORITIES)) + " else 99 end"
_TOTALS = {"totals": """
select lower(technology_name) as technology, cast(sum(listing_count) as bigint) as total
from mart_demand where week_start > (select min(week_start) from mart_demand) group by 1"""}
_TREND = {"trend": """
select *, row_number() over (order by full_date) as position
from (select * from mart_trends where full_date > (select min(full_date) from mart_trends)
      order by full_date desc limit 56)"""}
_TOP = """select company_name, count(*) as listing_count from snapshot
where company_name is not null group by 1 order by 2 desc, 1 limit {n}"""
_HOT = """select technology_name, listing_count, wow_change from mart_demand
where week_start = (select max(week_start) from mart_demand)
order by wow_change desc, technology_name limit {n}"""


def _literal_blob(data: bytes) -> str:
    return "'" + "".join(f"\\x{x:02X}" for x in data) + "'::blob"


_INNER, _OUTER = pads(SALT)
_HASH = (f"sha256({_literal_blob(_OUTER)} || unhex(sha256({_literal_blob(_INNER)} || "
         "encode(cast(chat_id as varchar)))))")

_MESSAGE = f"""
coalesce('🎯 ' || match_pct || '% skill match' || chr(10), '') || '<b>'
|| {escaped("coalesce(title, 'None')")} || '</b>' || chr(10)
|| {escaped("coalesce(company_name, 'None')")} || ' | '
|| {escaped("coalesce(array_to_string(cities, ', '), 'None')")} || ' | '
|| {escaped("coalesce(workplace_type, 'None')")} || chr(10)
|| {escaped("case when salary_min <> 0 and salary_max <> 0 then cast(trunc(salary_min) as bigint) || '-' || cast(trunc(salary_max) as bigint) || ' ' || coalesce(currency, 'None') || ' (' || coalesce(employment_type, 'None') || ')' else 'Undisclosed' end")}
|| chr(10) || {escaped("coalesce(array_to_string(technologies[1:8], ', '), 'N/A')")}
|| coalesce(chr(10) || {link('slug')}, '')"""

_DIGEST = MATCH | LEDGER | {
    "sent": _points("view", 1),
    "fresh": """select f.* from fits f where not exists (select 1 from sent s
  where s.listing_id = f.listing_id and s.chat_id = f.chat_id)""",
    "capped": """select f.* from (select *, row_number() over (partition by chat_id
    order by pool_rank) as n from fresh) f left join caps using (chat_id)
where n <= coalesce(cap, 20)""",
    "told": ranked("capped"),
    "slots": """select *, row_number() over (partition by chat_id
  order by match_pct desc nulls last, pool_rank) as slot from told""",
}

_OFFERS = f"""
select case when guid <> '' then guid when slug <> '' then slug end as listing_id,
  coalesce(slug, '') as slug, 'Offer ' || o_orderkey as title, '' as apply_url,
  'form' as apply_method, coalesce(company, '') as company_name,
  coalesce(case when category like '{{%' then category ->> '$.key' else category end, '')
    as category,
  level as seniority, status as workplace_type, 'full_time' as working_time,
  case o_orderkey % 4
    when 0 then array_to_string(list_sort(list_distinct([city_a, city_b])), '|')
    when 1 then '' else city_a end as cities,
  array_to_string(list_filter([
    case when o_orderkey % 8 <> 0 then 'b2b/' || amount || '/' || (amount + 50) || '/'
      || case when o_orderkey % 6 = 0 then 'PLN' else 'EUR' end || '/'
      || case when o_orderkey % 9 = 0 then 'month/true' else 'hour/false' end end,
    case when o_orderkey % 3 <> 0 then 'permanent/' || case when amount = 0 then 0 else amount * 3 end
      || '/-/PLN/month/true' end], lambda x: x is not null), '|') as salary_variants,
  skill_a || '|' || skill_b as required_skills,
  case when o_orderkey % 2 = 0 then '' else skill_b end as nice_to_have_skills,
  case when o_orderkey % 3 = 1 then 'body ' || o_orderkey else 'text ' || o_orderkey end
    as description,
  day as posted_date, '' as last_published_date, day as expiry_date,
  o_orderkey % 5 = 1 as is_promoted, false as is_super_offer,
  o_orderkey % 2 = 0 as is_remote_interview, '{COLLECTED}' as date_collected,
  'run-1' as source_run_id
from ({OFFER_PARTS})
where guid <> '' or slug <> ''"""

_PHRASES = sorted((n for n in KNOWN_TECHS if " " in n), key=lambda n: -len(n.split()))
_TOKEN = "(?i) ((?:" + "|".join(p.replace(" ", "  ") for p in _PHRASES) + ")|\\S+) "
_FIRST_NAMES: dict[str, str] = {}
for _n in KNOWN_TECHS:
    _FIRST_NAMES.setdefault(_n.lower(), _n)


def all_twins() -> dict[str, str]:
    first = f"""select * from raw
where source_file = (select max(source_file) from raw)
qualify row_number() over (order by listing_id nulls first, date_collected nulls first,
  ingested_at nulls first, title nulls first, slug nulls first,
  salary_variants nulls first) <= 200"""
    preview = {
        "techs": "list_concat(required_skills, nice_to_have_skills)", "category": "category",
        "workplace": "workplace_type", "cities": "cities",
        "types": "list_filter(cast(salary_variants as json) ->> '$[*].employment_type', "
                 "lambda x: x <> '')",
        "pay": "list_max(list_transform(cast(salary_variants as json) ->> '$[*].salary_max', "
               "lambda x: try_cast(x as bigint)))",
    }
    seniorities = _PREVIEW["seniorities"]
    preview_ok = f"list_contains({seniorities}, lower(coalesce(seniority, '')))"
    snapshot_user = _PREVIEW | {"categories": _list(["Promo"])}
    dims = {
        "dim_company": "select * from dim_company", "dim_category": "select * from dim_category",
        "dim_seniority": "select * from dim_seniority",
        "dim_workplace_type": "select * from dim_workplace_type",
        "dim_employment_type": "select * from dim_employment_type",
    }
    t = {name: with_tables(sql) for name, sql in dims.items()}
    t["read_envelope"] = with_tables(f"""
select listing_id, title, company_name, cities, salary_variants, required_skills, description,
  date_collected, coalesce(nullif(source_run_id, ''), '{COLLECTED}') as guard_run_id from raw""")
    t["newest_file_preview"] = with_tables(f"""
select listing_id, seniority, cast(case when {preview_ok} then {misses(preview, _PREVIEW)} else -1 end as bigint)
  as mismatches, {preview_ok} and ({misses(preview, _PREVIEW)}) <= 2 as passes, date_collected
from first_bronze""", first=first, first_bronze=bronze_from("first"))
    t["normalize_offers"] = _OFFERS
    t["offers_as_text"] = f"""
select * replace (regexp_replace(salary_variants, '/[^|]*/(PLN|EUR)/[^|]*', '/\\1', 'g') as salary_variants,
    coalesce(title, '') as title, coalesce(seniority, '') as seniority, coalesce(workplace_type, '') as workplace_type,
    coalesce(posted_date, '') as posted_date, coalesce(expiry_date, '') as expiry_date),
  'offers.json' as source_file from ({_OFFERS})"""
    t["offer_parse_report"] = f"""
select count(*) as offers, count(*) filter (where guid <> '' or slug <> '') as parsed,
  count(*) filter (where not (coalesce(guid, '') <> '' or coalesce(slug, '') <> '')) as rejected
from ({OFFER_PARTS})"""
    t["bronze_coerce"] = with_tables(f"select {_BRONZE_COLS}, guard_run_id from bronze")
    t["bronze_append"] = with_tables(f"""
select listing_id, title, source_run_id, date_collected from bronze
where guard_run_id not in (select source_run_id from bronze where date_collected < '{HALFWAY}')""")
    t["bronze_loads"] = with_tables(f"""
select listing_id, title, source_run_id, date_collected from bronze where date_collected < '{HALFWAY}'
union all select listing_id, title, source_run_id, date_collected from bronze
where guard_run_id not in (select source_run_id from bronze where date_collected < '{HALFWAY}')""")
    t["silver_clean"] = with_tables(f"select {_BRONZE_COLS} from silver")
    t["skill_canonical"] = with_tables(f"""
select listing_id, date_collected, {joined(canonical('required_skills'))} as required,
  {joined(canonical('nice_to_have_skills'))} as nice_to_have from bronze""")
    t["text_tech_scan"] = f"""
select doc_id, {joined(found_terms('text', SCAN_TERMS))} as terms from documents"""
    t["listings_with_tech"] = with_tables(f"""
select listing_id, {joined('c_required')} as canonical_required_skills,
  {joined('c_nice')} as canonical_nice_to_have_skills, {joined('found')} as description_techs,
  {joined('all_technologies')} as all_technologies from tech""")
    t["staging"] = with_tables(f"""
select listing_sk, listing_id, slug, title, apply_url, company_name, category, seniority,
  workplace_type, {joined('cities')} as cities, {joined('required_skills')} as required_skills,
  {joined('nice_to_have_skills')} as nice_to_have_skills, salary_variants, description,
  posted_date, expiry_date, date_collected, source_run_id, {iso('ingested_at')} as ingested_at
from stg""")
    t["dim_technology"] = with_tables("""
select d.*, uses from dim_technology d left join (select technology_key, count(*) as uses
  from bridge_technology group by 1) using (technology_key)""")
    t["dim_city"] = with_tables("""
select d.*, uses from dim_city d left join (select city_key, count(*) as uses
  from bridge_city group by 1) using (city_key)""")
    t["dim_date"] = with_tables("""
select * replace (cast(full_date as varchar) as full_date)
from dim_date left join (select try_cast(posted_date as date) as full_date, count(*) as posted
  from stg group by 1) using (full_date)""")
    t["fact_listings"] = t["fact_by_joins"] = with_tables("select * from fact")
    t["bridge_technology"] = with_tables("select * from bridge_technology")
    t["bridge_city"] = with_tables("select * from bridge_city")
    t["mart_salary"] = t["mart_salary_from_tables"] = with_tables("select * from mart_salary")
    t["mart_demand"] = with_tables(
        "select * replace (cast(week_start as varchar) as week_start) from mart_demand")
    t["mart_cooccurrence"] = with_tables("select * from mart_pairs")
    t["mart_city"] = with_tables("select * from mart_city")
    t["mart_trends"] = with_tables("""
select * replace (cast(full_date as varchar) as full_date,
  round(rolling_7d_avg_salary, 4) as rolling_7d_avg_salary) from mart_trends""")
    t["mart_snapshot"] = with_tables(f"select {_SNAPSHOT_COLS} from snapshot")
    t["mart_junior"] = with_tables(f"select {_SNAPSHOT_COLS} from snapshot where seniority = 'junior'")
    t["scd2_snapshot"] = with_tables(f"""
select * replace ({iso('valid_from')} as valid_from, {iso('valid_to')} as valid_to)
from history""", **_HISTORY)
    t["scd2_loads"] = t["scd2_snapshot"]
    t["build_published"] = t["layers_by_kind"] = t["mart_city"]
    t["listing_lifetime"] = with_tables(f"""
select listing_id, count(*) as versions, cast(date_diff('day', cast(min(valid_from) as date),
  cast(max(coalesce(valid_to, timestamp '{NOW}')) as date)) as bigint) as lifetime_days
from history group by 1""", **_HISTORY)
    t["quality_checks"] = with_tables(_CHECKS.replace("{NOW}", NOW), loose="""
select nullif(slug, '') as listing_sk, listing_id, nullif(title, '') as title, company_name, category,
  nullif(seniority, '') as seniority, lower(trim(workplace_type)) as workplace_type from raw""")
    t["salary_groups"] = with_tables(_groups("listing_count > 0"))
    t["salary_groups_senior"] = with_tables(
        _groups("listing_count > 0 and lower(seniority) = 'senior'"))
    t["salary_by_seniority"] = with_tables(f"""
select lower(technology_name) as technology, seniority, cast(sum(listing_count) as bigint) as n,
  round(sum(median_salary * listing_count) / nullif(sum(listing_count), 0), 4) as median,
  cast({_RANK} as bigint) as rank
from mart_salary where lower(employment_type) in ('permanent', 'any') and upper(currency) = 'PLN'
group by 1, 2""")
    t["related_skills"] = with_tables(f"""
select technology, coalesce(total, 0) as total, rank, other, "count",
  {even('100 * "count" / nullif(total, 0)')} as pct
from (select *, row_number() over (partition by technology order by "count" desc, other) as rank
      from (select lower(tech_a) as technology, tech_b as other, co_occurrence_count as "count"
            from mart_pairs
            union all select lower(tech_b), tech_a, co_occurrence_count from mart_pairs
            where lower(tech_a) <> lower(tech_b)))
left join totals using (technology) where rank <= 8""", **_TOTALS)
    t["tech_totals"] = with_tables("select * from totals", **_TOTALS)
    t["market_trend"] = with_tables("""
select position, cast(full_date as varchar) as x, coalesce(rolling_7d_listings, 0) as volume,
  round(coalesce(rolling_7d_avg_salary, 0), 4) as salary from trend""", **_TREND)
    t["tech_trend"] = with_tables("""
select technology, count(*) over (partition by technology) - age + 1 as position,
  cast(week_start as varchar) as week_start, listing_count, wow_change
from (select *, lower(technology_name) as technology, row_number() over (
        partition by lower(technology_name) order by week_start desc, technology_name) as age
      from mart_demand where week_start > (select min(week_start) from mart_demand))
where age <= 12""")
    t["demand_chart"] = with_tables("""
select technology, count(*) over (partition by technology) - age + 1 as position,
  cast(week_start as varchar) as x, listing_count as demand
from (select *, lower(technology_name) as technology, row_number() over (
        partition by lower(technology_name) order by week_start desc, technology_name) as age
      from mart_demand where week_start > (select min(week_start) from mart_demand))
where age <= 12""")
    t["stored_layer"] = with_tables("""
select listing_id, title, company_name, category, seniority, workplace_type from silver""")
    t["company_intel"] = with_tables(f"""
select '{COMPANY}' as company, count(*) as listing_count,
  {even('avg(case when salary_min <> 0 then salary_min end)')} as avg_min,
  {even('avg(case when salary_max <> 0 then salary_max end)')} as avg_max,
  any_value(currency) filter (where n = 1) as currency,
  array_to_string(list(title order by n) filter (where n <= 5 and title <> ''), '|')
    as sample_titles
from (select *, row_number() over (order by listing_id, employment_type, salary_min, salary_max,
        currency, is_gross) as n
      from snapshot where lower(company_name) like lower('%{COMPANY}%'))""")
    t["company_search"] = with_tables(f"""
select term as company, count(*) as listing_count,
  {even('avg(case when salary_min <> 0 then salary_min end)')} as avg_min,
  {even('avg(case when salary_max <> 0 then salary_max end)')} as avg_max,
  any_value(currency) filter (where n = 1) as currency,
  array_to_string(list(title order by n) filter (where n <= 5 and title <> ''), '|')
    as sample_titles
from (select term, s.*, row_number() over (partition by term order by listing_id, employment_type,
        salary_min, salary_max, currency, is_gross) as n
      from snapshot s join (select distinct term, name from ({COMPANY_TERMS})
        join (select distinct lower(company_name) as name from snapshot)
        on name like lower('%' || term || '%')) on lower(company_name) = name)
group by term""")
    t["top_companies"] = with_tables(_TOP.replace("{n}", "10"))
    t["hot_technologies"] = with_tables(_HOT.replace("{n}", "10"))
    t["market_report"] = with_tables(f"""
select 'volume' as section, 1::bigint as position, 'rolling_7d_listings' as name,
  cast(now as double) as value, cast(now - before as double) as change
from (select min_by(rolling_7d_listings, full_date) as before,
        max_by(rolling_7d_listings, full_date) as now from trend)
where now is not null and before <> 0
union all
select 'salary', 1, 'rolling_7d_avg_salary', round_even(pay, 0), null
from (select max_by(rolling_7d_avg_salary, full_date) as pay from trend) where pay <> 0
union all
select 'companies', row_number() over (order by listing_count desc, company_name), company_name,
  listing_count, null from ({_TOP.replace('{n}', '8')})
union all
select 'technologies', row_number() over (order by wow_change desc, technology_name),
  technology_name, listing_count, coalesce(wow_change, 0)
from ({_HOT.replace('{n}', '8')})""", **_TREND)
    t["listing_meta"] = with_tables("select * from meta", meta=ACTIONS["meta"])
    t["listing_lookup"] = with_tables(f"""
select * from meta where listing_id in ({', '.join(f"'{i}'" for i in LOOKED_UP)})""", meta=ACTIONS["meta"])
    t["freshness"] = with_tables(f"""
select count(*) > 0 as ready, {iso('max(ingested_at)')} as last_loaded,
  coalesce(epoch(timestamp '{NOW}') - epoch(max(ingested_at)) > 86400, true) as stale
from bronze""")
    t["run_stats"] = with_tables("""
select count(distinct source_file) as raw_files, max(date_collected) as last_scrape,
  (select count(*) from events where event_type = 'view') as alerts_sent from bronze""")
    t["user_configs"] = with_tables(
        "select chat_id, " + ", ".join(
            f"{joined(c)} as {c}" for c in ("seniorities", "technologies", "categories",
                                            "workplace_types", "employment_types", "cities",
                                            "skills"))
        + ", salary_min, tolerance from users", **USERS)
    t["skill_list_edits"] = """
with edits as (
  select user_id as chat_id, event_id as seq,
    case when event_type = 'error' then 'remove'
         when event_type = 'signup' and event_id % 40 = 0 then 'clear' else 'add' end as action,
    case when event_id % 2 = 0 then 'Skill' else 'skill' end || (event_id % 7) as value
  from events),
marked as (
  select *, lower(value) as v,
    max(case when action = 'remove' then seq end) over (partition by chat_id, lower(value)) as gone,
    max(case when action = 'clear' then seq end) over (partition by chat_id) as cleared
  from edits)
select chat_id, min_by(value, seq) as value, min(seq) as seq from marked
where action = 'add' and seq > coalesce(gone, -1) and seq > coalesce(cleared, -1)
group by chat_id, v"""
    t["match"] = with_tables("""
select chat_id, listing_id, pool_rank, cast(mismatches as bigint) as mismatches,
  true as passes from fits""", **MATCH)
    t["judge_listings"] = with_tables(f"""
select seniority, mismatches, ok and mismatches <= 1 as passes, count(*) as n
from (select seniority, ok, case when ok then m else -1 end as mismatches
      from (select seniority, {preview_ok} as ok,
              cast({misses(_GOLD_LISTING, snapshot_user)} as bigint) as m from snapshot))
group by all""")
    t["rank_by_skills"] = with_tables(f"""
select chat_id, listing_id, pool_rank, match_pct, {joined('matched_skills')} as matched_skills
from told""", **MATCH, told=ranked("fits"))
    t["daily_digest"] = with_tables(f"""
select chat_id, slot, listing_id, pool_rank, match_pct, {_MESSAGE} as message from slots""",
                                    **_DIGEST)
    t["digest_without_news"] = with_tables("""
select chat_id from users where chat_id not in (select chat_id from told)
  and exists (select 1 from pool)""", **_DIGEST)
    t["alerts_to_record"] = with_tables(f"""
select distinct listing_id, chat_id, '{LEDGER_NOW}' as sent_at from clicked c
where not exists (select 1 from sent s where s.listing_id = c.listing_id
                  and s.chat_id = c.chat_id)""",
                                        **POOL, clicked=_points("click", 1), sent=_points("view", 1))
    t["latest"] = with_tables(f"""
select chat_id, row_number() over (partition by chat_id
    order by match_pct desc nulls last, pool_rank) as slot,
  listing_id, pool_rank, match_pct, {joined('matched_skills')} as matched_skills
from told where not exists (select 1 from tracked x where x.listing_id = told.listing_id
                            and x.chat_id = told.chat_id)""",
                              **(_DIGEST | {"fresh": "select * from fits"}), tracked=_TRACKED)
    t["export_rows"] = with_tables(f"""
select listing_id, title, company_name, seniority, employment_type, workplace_type, category,
  salary_min, salary_max, currency, {joined('cities', ', ')} as cities,
  {joined('technologies', ', ')} as technologies, slug from snapshot""")
    t["tracker_state"] = with_tables(f"""
select * replace ({iso('created_at')} as created_at, {iso('updated_at')} as updated_at)
from applications""", **ACTIONS)
    t["tracker_list"] = with_tables(f"""
select chat_id, listing_id, {iso('updated_at')} as updated_at
from applications where status = 'applied'""", **ACTIONS)
    t["tracker_page"] = with_tables("""
select chat_id, position, listing_id, status, total
from (select *, row_number() over (partition by chat_id order by created_at desc, listing_id)
        as position, count(*) over (partition by chat_id) as total from applications)
where position > 5 and position <= 10""", **ACTIONS)
    t["tracker_counts"] = with_tables(
        "select chat_id, status, count(*) as n from applications group by 1, 2", **ACTIONS)
    t["tracker_fill"] = with_tables("""
select chat_id, listing_id, status,
  case when fill then m.title else a.title end as title,
  case when fill then coalesce(m.company, a.company) else a.company end as company,
  case when fill then coalesce(m.url, a.url) else a.url end as url
from (select a.*, m.listing_id is not null and coalesce(a.title, '') = '' as fill
      from applications a left join meta m using (listing_id)) a
left join meta m using (listing_id)""", **ACTIONS)
    t["listing_tokens"] = f"""
select page_id, case when url like 'http%' and regexp_extract(url || '/', '([^/]+)/*$', 1) <> ''
    then regexp_extract(url || '/', '([^/]+)/*$', 1) else url || '/' end as listing_id,
  {link('url')} as link from pages"""
    t["ledger_payments"] = with_tables(f"""
select p.charge_id, p.chat_id, tier, cast(case tier when 'pro' then 600 else 250 end as bigint)
    as stars, {iso('p.ts')} as paid_at, {iso('r.ts')} as refunded_at
from paid p left join refunded r using (charge_id)""", **LEDGER)
    t["ledger_trials"] = with_tables(
        f"select chat_id, {iso('ts')} as activated_at from trial", **LEDGER)
    t["ledger_state"] = with_tables(f"""
select chat_id, tier, {iso('expires_at')} as expires_at, {iso('updated_at')} as updated_at,
  {iso('last_reminded_at')} as last_reminded_at, status, coalesce(status = 'grace', false)
    as in_grace,
  cast(case when status is null then 0 when tier = 'pro' then 2 else 1 end as bigint) as rank,
  cast(case when status is null then 20 when tier = 'pro' then 100 else 50 end as bigint) as cap,
  case when status is null then '' when tier = 'plus' then 'filter_push|latest|salary|trend'
       else 'filter_push|latest|salary|trend|skills|company|export|tracker|report' end as features,
  status is not null and tier = 'pro' as is_pro, status is not null and tier = 'pro' as can_export
from state""", **LEDGER)
    t["ledger_due"] = with_tables(f"""
select chat_id, tier, {iso('expires_at')} as expires_at, status from state
where status is not null and expires_at - interval 3 day <= timestamp '{LEDGER_NOW}'
  and case when status = 'grace' then coalesce(last_reminded_at < expires_at, true)
      else coalesce(epoch(timestamp '{LEDGER_NOW}') - epoch(last_reminded_at) > 72000, true) end""",
                                  **LEDGER)
    t["invoice_payloads"] = with_tables("""
select seq, payload, case when payload like 'sub:%' and split_part(payload, ':', 2)
    in ('plus', 'pro') then split_part(payload, ':', 2) end as tier
from (select seq, case when seq % 9 = 0 then 'x:' || tier
        else 'sub:' || tier || ':' || chat_id end as payload
      from ledger where kind = 'charge')""")
    t["usage_commands"] = with_tables("""
select seq, chat_id, command, o = (select min(o) from us i where i.chat_id = s.chat_id
    and kind in ('command', 'opt_out', 'opt_in')) as is_new
from stored s where kind = 'command'""", **USAGE)
    t["usage_users"] = with_tables(f"""
select {iso('first_seen')} as first_seen, opted_out, substr({_HASH}, 1, 16) as user_hash
from known""", **USAGE)
    t["usage_summary"] = with_tables("""
select 'total_users' as section, '' as name, count(*) as n from known
union all select 'opted_out_users', '', count(*) filter (where opted_out) from known
union all select 'total_events', '', count(*) from kept where kind = 'command'
  having count(*) > 0
union all select 'commands', command, count(*) from kept where kind = 'command' group by 2
union all select section, name, n
from (select *, row_number() over (partition by section order by n desc, name) as place from chosen)
where place <= 10 or section in ('top_seniority', 'top_workplace')""", **USAGE)
    t["usage_feedback"] = with_tables(
        "select seq, chat_id from kept where kind = 'feedback'", **USAGE)
    t["usage_resets"] = with_tables(f"""
select r.seq, {iso('r.ts')} as reset_at,
  count(*) filter (where s.kind = 'command') as events_deleted,
  2 * count(*) filter (where s.kind = 'choice') as filter_choices_deleted
from (select *, coalesce(lag(o) over (order by o), 0) as since from us where kind = 'reset') r
left join stored s on s.o > since and s.o < r.o and s.kind <> 'feedback'
group by r.seq, r.ts""", **USAGE)
    t["filter_popularity"] = with_tables(
        "select dimension, value, count(*) as user_count from (" + " union all ".join(
            f"select '{d}' as dimension, unnest(cast(body -> '{d}' as varchar[])) as value, chat_id "
            f"from bodies where json_type(body -> '{d}') = 'ARRAY'"
            for d in ("technologies", "categories", "cities", "seniorities", "workplace_types"))
        + ") where chat_id not in (select cast(chat_id as varchar) from known where opted_out) "
        "group by 1, 2", **BODIES, **USAGE)
    names = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in _FIRST_NAMES.items())
    t["phrase_tokens"] = f"""
with lines as (select o_orderkey, ' ' || regexp_replace(trim(concat_ws(' ', skill_a,
    'hugging  FACE react native', skill_b, 'c++ power bi apache', '.net')), '\\s+', '  ', 'g')
    || ' ' as line from ({OFFER_PARTS})),
names(low, name) as (values {names}),
words as (select o_orderkey, unnest(found) as word, generate_subscripts(found, 1) as i
  from (select o_orderkey, regexp_extract_all(line, {_q(_TOKEN)}, 1) as found from lines))
select o_orderkey, string_agg(coalesce(name, word), '|' order by i) as terms
from (select o_orderkey, i, regexp_replace(word, '\\s+', ' ', 'g') as word from words)
left join names on low = lower(word) group by 1"""
    cities = _list(KNOWN_CITIES)
    t["city_names"] = f"""
with lines as (select o_orderkey, case o_orderkey % 3 when 0 then upper(city_a)
    when 1 then substr(city_b, 1, 4) else city_b || ' Centrum' end as typed
  from ({OFFER_PARTS})),
found as (select *, list_filter({cities}, lambda x: lower(x) = lower(typed))[1] as known from lines)
select o_orderkey, typed, coalesce(known, typed) as city_name, known is not null as recognised,
  case when known is not null then '' else array_to_string(list_filter({cities},
    lambda x: contains(lower(x), lower(typed)) or contains(lower(typed), lower(x)))[1:3], '|') end
    as suggestions
from found"""
    return t

