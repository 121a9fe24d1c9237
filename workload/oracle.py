"""The SQL counterpart of every query, written for DuckDB on the same tables."""

from __future__ import annotations

# Fixed values, written out here so that a wrong one in the package shows.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x1c\x1d\x1e\x1f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
ACCENTED, PLAIN = "áéíóúñ", "aeioun"

AS_OF = "date '1998-07-15'"
MONTH = "{0} >= date '1998-07-01' and {0} < date '1998-08-01'"
PRICE = "cast(l_extendedprice as decimal(18,2))"
NET = f"{PRICE} * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))"
BALANCE = f"case when l_linestatus = 'O' then {NET} else 0 end"
DUE = "cast(l_shipdate as date)"

BREAKS = " \t\n\x0b\f\r[](){}/|\\<>!?@\"^#$&~_,.:;*%+-"
CLASS = "".join(("\\" + c) if c in "[]\\^-" else c for c in BREAKS)


# The engine writes a capital sharp s, which simple case mapping does not have: keep the small one.
TITLE_WORD = "case when w[1:1] = 'ß' then 'ß' else upper(w[1:1]) end || lower(w[2:])"


def title(x: str) -> str:
    pieces = f"regexp_extract_all({x}, '[{CLASS}]+|[^{CLASS}]+')"
    return f"array_to_string(list_transform({pieces}, lambda w: {TITLE_WORD}), '')"


def title_space(x: str) -> str:
    words = f"string_split({x}, ' ')"
    return f"array_to_string(list_transform({words}, lambda w: {TITLE_WORD}), ' ')"


def trim(x: str) -> str:
    return f"trim({x}, '{WHITE_SPACE}')"


def strip(x: str, chars: str = "-.") -> str:
    for c in chars:
        x = f"replace({x}, '{c}', '')"
    return x


def name_words(a: str, b: str, c: str) -> str:
    parts = [title(trim(a)), title(trim(strip(b))), title(trim(strip(c)))]
    return trim(" || ' ' || ".join(f"coalesce({p}, '')" for p in parts))


def name_strict(a: str, b: str, c: str, chars: str = "") -> str:
    parts = [title(trim(a)), title(trim(strip(b, chars))), title(trim(strip(c, chars)))]
    return trim(" || ' ' || ".join(parts))


def fold(x: str) -> str:
    return f"translate({x}, '{ACCENTED}', '{PLAIN}')"


def cents(x: str) -> str:
    return f"round_even(({x}) * 100.0, 0) / 100.0"


def to_int(x: str) -> str:
    number = f"try_cast({x} as decimal(38,9))"
    return f"coalesce(case when {number} = floor({number}) then cast({number} as bigint) end, 0)"


def money_text(x: str) -> str:
    digits = f"regexp_replace(regexp_replace({x}, '[^0-9.\\-]', '', 'g'), '\\.+', '.', 'g')"
    return cents(f"try_cast({digits} as double)")


FUNDS = f"""
  left join (
    select l_orderkey,
      nullif({PRICE} * cast(l_discount as decimal(4,2)), 0) as fee,
      nullif({PRICE} * cast(l_tax as decimal(4,2)), 0) as reserve,
      case when l_returnflag = 'A' then {PRICE} end as fund
    from lineitem
  ) d on d.l_orderkey = o.o_orderkey
"""

PARTS = "part p left join nation n on p.p_size = n.n_nationkey"

BRAND = """(
  select n_name as raw_name, r_name as brand, replace(n_name, 'NATION_', 'Nation ') as development,
    'S' || n_regionkey as section
  from nation join region on n_regionkey = r_regionkey
)"""

SELLER = """(
  select 'Supplier S' || split_part(s_name, '#', 2) || ' K' || s_nationkey as seller, n_name as branch,
    case when s_acctbal > 5000 then 'internal' else 'external' end as seller_kind, r_name as team
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey
)"""

STATUS = """(
  select case r_regionkey when 0 then 'F' when 1 then 'O' when 2 then 'P' when 3 then 'purchase'
    else 'signup' end as status_id, r_name as name
  from region
)"""

CUSTOMER_PARTS = (
    "split_part(c_name, '#', 1)",
    "'-' || split_part(c_name, '#', 2)",
    "nullif(c_mktsegment, 'MACHINERY')",
)
SUPPLIER_PARTS = ("split_part(s_name, '#', 1)", "'S.-' || split_part(s_name, '#', 2)", "'K' || s_nationkey")


def per_sale(name: str, aggregate: str) -> str:
    return f"select l_orderkey as sale_id, {aggregate} as {name} from lineitem group by l_orderkey"


LATE = f"({BALANCE}) <> 0 and {DUE} < {AS_OF}"
AHEAD = f"({BALANCE}) <> 0 and {DUE} >= {AS_OF}"
OVERDUE = f"sum(case when {LATE} then {BALANCE} else 0 end)"
FIRST_OVERDUE = f"min(case when {LATE} then {DUE} end)"
NEXT_BALANCE = (
    f"arg_min({BALANCE}, {{'due': {DUE}, 'no': l_linenumber, 'bal': {BALANCE}}}) filter (where {AHEAD})"
)
REQUIRED = f"{OVERDUE} + coalesce({NEXT_BALANCE}, 0)"
OVERDUE_BILLED = f"sum(case when {LATE} then {PRICE} else 0 end)"
NEXT_ON = f"min(case when {AHEAD} then {DUE} end)"
NEXT_NUMBER = f"min(case when {AHEAD} then l_linenumber end)"
DUE_DAY = f"cast(max(case when l_returnflag = 'N' then day({DUE}) end) as int)"
KIND_AMOUNT = (
    f"arg_min({PRICE}, {{'due': {DUE}, 'no': l_linenumber, 'b': {PRICE}}}) filter (where l_returnflag = 'N')"
)


def double(x: str) -> str:
    return f"cast({x} as double)"


PEOPLE = """(
  select c_custkey, split_part(c_name, '#', 1) || ' ana-maria  x.y' as first,
    ' -' || split_part(c_name, '#', 2) || '.o''NEIL ' as last1,
    nullif(c_mktsegment, 'MACHINERY') as last2
  from customer
)"""

DIRTY_DATE = """
case o_orderpriority
  when '1-URGENT' then '0000-00-00'
  when '2-HIGH' then strftime(o_orderdate, '%Y-%m-%d')
  when '3-MEDIUM' then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  when '4-NOT SPECIFIED' then strftime(o_orderdate, '%d/%m/%Y')
  else strftime(o_orderdate, '%Y-%m-%d') || 'T10:30:00' ||
    case o_orderstatus when 'O' then '+05:00' when 'F' then 'Z' else 'Q' end
end
"""


def parse_date(x: str) -> str:
    wall = f"regexp_replace({x}, '(\\d{{2}}:\\d{{2}}:\\d{{2}})(Z|[+-]\\d{{2}}:\\d{{2}})$', '\\1')"
    return f"coalesce(try_cast({wall} as timestamp), try_strptime({x}, '%d/%m/%Y'))"


DIRTY_MONEY = """
case
  when l_linenumber = 1 then '$' || format('{:,.2f}', l_extendedprice)
  when l_linenumber = 2 then '(' || cast(cast(l_extendedprice as decimal(18,2)) as varchar) || ')'
  when l_linenumber = 3 then '12-' || l_partkey
  when l_linenumber = 4 then l_partkey || '..' || l_suppkey
  when l_linenumber = 5 then '-$' || l_partkey
  when l_linenumber = 6 then l_partkey || '.1.2'
end
"""

DIRTY_INT = """
case
  when l_linenumber <= 2 then '00' || l_partkey
  when l_linenumber = 3 then 'x' || l_partkey
  when l_linenumber = 4 then l_partkey || '.5'
  when l_linenumber = 5 then ' ' || l_suppkey || '.0 '
  when l_linenumber = 6 then '-' || l_suppkey
end
"""

SIZE = """case p_type when 'ECONOMY' then p_size when 'SMALL' then p_size - 20 when 'LARGE' then p_size * 2 end"""

COOWNERS = f"""
  select l_orderkey as owner_key,
    string_agg(name, ', ' order by name) as coowners
  from (
    select l_orderkey, split_part(s_name, '#', 1) || ' S.-' || split_part(s_name, '#', 2) || ' K' || s_nationkey as name
    from lineitem join supplier on l_suppkey = s_suppkey
  )
  group by l_orderkey
"""

# ------------------------------------------------------------------ reports

OVERDUE_PORTFOLIO = """
select c_custkey as client_id, c_mktsegment as development, split_part(c_name, '#', 2) as unit,
  c_name as client, lower(c_mktsegment) || '@example.org' as email, '+52' || c_custkey as phone,
  date '1970-01-01' + cast(c_custkey as int) as birth_date, c_acctbal as total_paid,
  cast(cast(c_acctbal as decimal(18,2)) * 0.50 as double) as overdue_balance,
  date '1998-01-01' + c_nationkey as paid_on, c_nationkey + 1 as overdue_day,
  split_part(c_name, '#', 1) as holder_name, 'condo' as system
from customer
"""

STATEMENT_FLAT = """
select c_custkey as client_id, n_name || ' ' || nullif(c_mktsegment, 'MACHINERY') as unit_key,
  n_name as brand, n_name as development, nullif(c_mktsegment, 'MACHINERY') as unit,
  'E' || n_regionkey as stage, c_name as client, lower(c_mktsegment) || '@example.org' as email,
  '+52' || c_custkey as phone,
  'REF_' || nullif(split_part(c_name, '#', 2), '000000007') as reference,
  c_acctbal as billed_total,
  cast(cast(c_acctbal as decimal(18,2)) * 0.60 as double) as receivable_total,
  cast(cast(c_acctbal as decimal(18,2)) * 0.10 as double) as overdue_balance,
  c_nationkey * 3 as days_late, date '1998-07-01' + c_nationkey as next_due_on,
  c_nationkey + 1 as due_day,
  cast(cast(c_acctbal as decimal(18,2)) * 0.40 as double) as collected_total,
  cast(0 as double) as unapplied_balance, date '1998-07-01' - c_nationkey as last_paid_on
from customer join nation on c_nationkey = n_nationkey
"""

INCOME_FLAT = f"""
select o_orderkey as payment_id, o_custkey as client_id, o_orderpriority as development,
  'U' || o_custkey as unit, 'REF_' || nullif(cast(o_custkey as varchar), '7') as reference,
  'F-' || o_orderkey as folio, o_orderdate as paid_on, cast(o_orderdate as date) as registered_on,
  'Client ' || o_custkey as client, o_totalprice as amount, o_orderpriority as bank,
  '00' || o_custkey as account, o_orderstatus as pay_form, 'user ' || (o_orderkey % 50) as registered_by,
  o_orderstatus as status, 'condo' as system,
  cast(cast(o_totalprice as decimal(18,2)) * 0.05 as double) as unapplied_balance,
  o_orderkey * 10 as detail_id,
  cast(cast(o_totalprice as decimal(18,2)) * 0.50 as double) as fee_amount,
  cast(cast(o_totalprice as decimal(18,2)) * 0.30 as double) as reserve_amount,
  cast(cast(o_totalprice as decimal(18,2)) * 0.15 as double) as fund_amount
from orders
where year(o_orderdate) = 1998 and month(o_orderdate) = 7
"""

FUND_SPLIT = f"""
with rows as (
  select o.o_orderkey as payment_id, c.c_nationkey as property_id, b.brand, b.development, b.section,
    'E' || p.n_regionkey as stage, 'U' || p.n_nationkey as unit, 'F-' || o.o_orderkey as folio,
    {name_words(*CUSTOMER_PARTS)} as client,
    {name_words("'agent'", "c_mktsegment", "cast(null as varchar)")} as "user",
    t.account, o.o_orderdate, o.o_orderpriority as bank, f.r_name as pay_form,
    cast(o.o_totalprice as decimal(18,2)) as amount, d.fee, d.reserve, d.fund
  from orders o
  {FUNDS}
  left join (
    select o_orderkey, cast(o_custkey as varchar) as account from orders where o_orderpriority <> '3-MEDIUM'
  ) t on t.o_orderkey = o.o_orderkey
  left join region f on f.r_regionkey = case o.o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1
    when '3-MEDIUM' then 2 when '4-NOT SPECIFIED' then 3 else 9 end
  left join customer c on c.c_custkey = o.o_custkey
  left join nation p on p.n_nationkey = c.c_nationkey
  left join {BRAND} b on b.raw_name = p.n_name
  where o.o_orderstatus = 'O'
)
select payment_id, property_id as sale_id, brand, development, section, stage, unit, folio, client, "user",
  'REF_' || account as reference, cast(o_orderdate as date) as paid_on, bank, pay_form,
  cast(amount as double) as amount,
  cast(case when fee is null and reserve is null and fund is null then 0 else coalesce(fee, 0) end as double)
    as fee_amount,
  cast(case when fee is null and reserve is null and fund is null then 0 else coalesce(reserve, 0) end as double)
    as reserve_amount,
  cast(case when fee is null and reserve is null and fund is null then 0 else coalesce(fund, 0) end as double)
    as fund_amount,
  cast(case when fee is null and reserve is null and fund is null then amount else 0 end as double)
    as future_funds
from rows
where development is not null and development <> 'Nation 4' and "user" <> 'Agent Machinery'
  and pay_form is not null and not (development = 'Nation 10' and section = 'S0')
  and bank not in ('2-HIGH')
  and year(o_orderdate) = 1998 and month(o_orderdate) = 7
"""


def statement_sales(coowner: str = "") -> str:
    client = fold(name_strict(*CUSTOMER_PARTS))
    second = fold(title(trim("co.coowners"))) if coowner else client
    join = f"left join ({COOWNERS}) co on co.owner_key = s.o_orderkey" if coowner else ""
    seller = trim(f"regexp_replace({name_strict(*SUPPLIER_PARTS, '-')}, 'K16|\\.', '', 'g')")
    return f"""
with approved as (
  select l_orderkey, l_orderkey * 10 + l_linenumber as payment_id, l_shipdate, {PRICE} as amount
  from lineitem where l_returnflag <> 'N'
), latest as (
  select l_orderkey, max({{'id': payment_id, 'd': l_shipdate, 'a': amount}}) as m
  from approved group by l_orderkey
), paid as (
  select l_orderkey, cast(m.d as date) as last_paid_on, m.a as last_paid_amount,
    case when year(m.d) = 1998 and month(m.d) = 7 then m.a else 0 end as month_amount
  from latest
), aged as (
  select l_orderkey, {FIRST_OVERDUE} as first_overdue_on, {OVERDUE} as overdue_balance,
    {REQUIRED} as required_total, {NEXT_ON} as next_due_on, {NEXT_NUMBER} as next_due_number,
    {DUE_DAY} as due_day, {KIND_AMOUNT} as instalment_amount
  from lineitem group by l_orderkey
), promised as (
  select user_id, max(case when event_type <> 'error' then cast(ts as date) end) as promised_on
  from events group by user_id
), signed as (
  select user_id, min(case when lower(st.name) like 'eur%' and event_id % 7 <> 0 then cast(ts as date) end) as signed_on
  from events left join {STATUS} st on st.status_id = event_type group by user_id
), sellers as (
  select s_suppkey, {seller} as seller from supplier
)
select distinct s.o_orderkey as sale_id,
  case when b.development in ('Nation 3', 'NATION_3') then n.n_name || ' ' || p_name || ' ' || p_type
    else n.n_name || ' ' || p_name end as unit_key,
  b.brand, b.development, b.section, p_type as stage, p_name as unit,
  {client} as client, {second} as coowner, sellers.seller, sd.branch, sd.seller_kind, sd.team,
  '+52' || c_custkey as phone, lower(c_mktsegment) || '@example.org' as email,
  'ref_00' || p_partkey as reference, st.name as status,
  case when s.o_orderpriority <> '3-MEDIUM' then cast(s.o_orderdate as date) end as contract_on,
  signed.signed_on, s.o_totalprice as price, aged.due_day,
  cast(cast(s.o_totalprice as decimal(18,2)) * 0.40 as double) as collected,
  cast(case when s.o_orderpriority = '5-LOW' then null
    when 100000 > cast(s.o_totalprice as decimal(18,2)) * 0.40
    then cast(s.o_totalprice as decimal(18,2)) * 0.40 else 100000 end as double) as down_payment_paid,
  cast(cast(s.o_totalprice as decimal(18,2)) * 0.60 as double) as receivable,
  cast(month(s.o_orderdate) * 6 + 1 as int) as financed_months,
  cast(aged.instalment_amount as double) as instalment_amount,
  cast(aged.required_total as double) as required_total,
  cast({AS_OF} - aged.first_overdue_on as int) as days_overdue,
  paid.last_paid_on, cast(paid.month_amount as double) as collected_this_month,
  cast(aged.overdue_balance as double) as overdue_balance, aged.next_due_number, aged.next_due_on,
  cast(paid.last_paid_amount as double) as last_paid_amount,
  case when aged.first_overdue_on is not null then promised.promised_on end as promised_on
from orders s
left join paid on paid.l_orderkey = s.o_orderkey
left join aged on aged.l_orderkey = s.o_orderkey
left join promised on promised.user_id = s.o_orderkey
left join signed on signed.user_id = s.o_orderkey
{join}
left join customer on c_custkey = s.o_custkey
left join part on p_partkey = s.o_custkey
left join sellers on sellers.s_suppkey = s.o_orderkey % 50
left join nation n on n.n_nationkey = p_size
left join {STATUS} st on st.status_id = s.o_orderstatus
left join {BRAND} b on b.raw_name = n.n_name
left join {SELLER} sd on sd.seller = sellers.seller
where s.o_orderstatus in ('F', 'O')
"""


def income_sales(grain: str) -> str:
    by_payment = grain == "payment"
    user = name_words(*SUPPLIER_PARTS)
    seller = trim(f"replace(replace({user}, 'K16', ''), '.', '')")
    flows = (
        "string_agg(distinct flow_concept, ', ' order by flow_concept) as flow_concepts"
        if by_payment
        else "flow_concept, min(flow_amount) as amount"
    )
    # Join first and group after, the other way round from the query.
    return f"""
with pay as (
  select l_orderkey as sale_id, l_orderkey * 10 + l_linenumber as payment_id,
    cast(l_shipdate as date) as paid_on,
    cast(l_shipdate as date) - cast(l_quantity as int) as created_on,
    {PRICE} as paid, cast(l_tax as decimal(18,2)) as surcharge, 'F-' || l_partkey as folio,
    {trim(title("'instalment-' || lower(l_linestatus) || ' paid'"))} as concept,
    b.n_name as bank, {trim(title("f.r_name"))} as pay_form
  from lineitem
  left join nation b on b.n_nationkey = l_linenumber
  left join region f on f.r_regionkey = l_linenumber - 1
  where l_linestatus = 'O' and l_returnflag <> 'N'
), flow as (
  select l_orderkey as sale_id, l_orderkey * 10 + l_linenumber as payment_id,
    {NET} as flow_amount, l_returnflag as flow_concept
  from lineitem where l_quantity >= 10
), rolled as (
  select pay.sale_id, pay.payment_id, pay.surcharge, min(paid_on) as paid_on, min(created_on) as created_on,
    {"min(paid) as amount," if by_payment else ""} max(folio) as folio, max(concept) as concept,
    max(bank) as bank, max(pay_form) as pay_form, {flows}
  from pay left join flow on flow.payment_id = pay.payment_id and flow.sale_id = pay.sale_id
  where {MONTH.format("paid_on")}
  group by pay.sale_id, pay.payment_id, pay.surcharge{"" if by_payment else ", flow_concept"}
), users as (
  select s_suppkey, {user} as name, {seller} as seller from supplier
)
select distinct r.sale_id,
  case when s.o_orderpriority = '5-LOW' and n.n_name in ('Nation 3', 'NATION_3')
    then n.n_name || ' ' || p_name || ' ' || p_type else n.n_name || ' ' || p_name end as unit_key,
  b.brand, b.development, p_brand as section, p_type as stage, p_name as unit, r.folio,
  {fold(name_words(*CUSTOMER_PARTS))} as client, 'REF_00' || p_partkey as reference, st.name as status,
  r.payment_id, r.paid_on, r.created_on, cast(r.amount as double) as amount,
  {"cast(r.surcharge as double) as surcharge," if by_payment else ""}
  r.pay_form, r.concept, r.{"flow_concepts" if by_payment else "flow_concept"}, r.bank,
  a.name as assigned_by
from rolled r
left join orders s on s.o_orderkey = r.sale_id
left join customer on c_custkey = s.o_custkey
left join part on p_partkey = s.o_custkey
left join users u on u.s_suppkey = s.o_orderkey % 50
left join nation n on n.n_nationkey = p_size
left join {STATUS} st on st.status_id = s.o_orderstatus
left join events e on e.event_id = r.payment_id
left join users a on a.s_suppkey = e.user_id
left join {BRAND} b on b.raw_name = n.n_name
where {name_words(*CUSTOMER_PARTS)} not like '%Furniture%' and u.seller not like '%K7%'
  and b.development not in ('Nation 5', 'Nation 6')
"""


def counted(report: str, columns: int, sql: str) -> str:
    return f"select '{report}' as report, count(*) as row_count, cast({columns} as int) as column_count from ({sql})"


ORACLE: dict[str, str] = {
    "src_table_scan": "select c_custkey, c_name, c_acctbal from customer",
    "src_federated": "select o_orderkey as sale_id, o_custkey as client_id, o_orderstatus as status_id,"
    " cast(o_totalprice as decimal(18,2)) as price from orders where o_orderstatus = 'O'",
    "src_dimension": f"select * from {BRAND}",
    "run_all_reports": " union all ".join(
        [
            counted("overdue_portfolio", 13, OVERDUE_PORTFOLIO),
            counted("statement_flat", 19, STATEMENT_FLAT),
            counted("income_flat", 21, INCOME_FLAT),
            counted("income_fund_split", 19, FUND_SPLIT),
            counted("statement_sales", 35, statement_sales()),
            counted("income_sales", 21, income_sales("payment")),
            counted("income_by_concept", 20, income_sales("concept")),
        ]
    ),
    "report_shape": "select 'orders' as report, count(*) as row_count, cast(6 as int) as column_count from orders",
    "sink_dated_folder": "select * from orders",
    "sink_manifest": """
        select 'newest' as report, count(*) as row_count, cast(6 as int) as column_count from orders
        union all select 'first', count(*), cast(6 as int) from orders where o_orderstatus = 'O'""",
    "sink_skip_empty": """
        select r.report, count(*) as row_count, cast(6 as int) as column_count
        from (values ('open', 'O'), ('unknown', 'X')) r(report, status)
        join orders on o_orderstatus = r.status group by r.report""",
    "sink_display_text": f"""
        select cast(l_orderkey as varchar) as l_orderkey, cast(l_linenumber as varchar) as l_linenumber,
          strftime(l_shipdate, '%d/%m/%Y') as ship_date,
          case when v < 0 then '-' else '' end || '$' || format('{{:,.2f}}', abs(v)) as net_amount,
          cast(l_partkey as varchar) as part_number, l_returnflag
        from (select *, {cents("l_extendedprice - 20000.0")} as v from lineitem)""",
    "sink_typed_report": f"""
        select payment_id, client_id, development, unit, coalesce(reference, '') as reference, folio,
          cast(paid_on as timestamp) as paid_on, cast(registered_on as timestamp) as registered_on, client,
          {cents("amount")} as amount, bank, account, pay_form, registered_by, status, system,
          {cents("unapplied_balance")} as unapplied_balance, detail_id, {cents("fee_amount")} as fee_amount,
          {cents("reserve_amount")} as reserve_amount, {cents("fund_amount")} as fund_amount
        from ({INCOME_FLAT})""",
    "sink_observed_metrics": """
        select 'orders' as report, (select count(*) from orders) as row_count, "column",
          least(50.0::double, greatest(8.0::double,
            (greatest(coalesce(longest, 0), length("column")) + 2) * 1.1::double)) as width,
          rejects, null::bigint as unread,
          case "column" when 'o_totalprice' then 'price' when 'o_orderpriority' then 'riority' end as partial
        from (
          select 'o_orderkey' as "column", max(length(cast(nullif(o_orderkey, 0) as varchar))) as longest,
            null::bigint as rejects from orders
          union all select 'o_custkey', max(length(cast(nullif(o_custkey, 0) as varchar))), null from orders
          union all select 'o_orderstatus', max(length(o_orderstatus)), null from orders
          union all select 'o_totalprice',
            max(length(cast(case when o_totalprice = floor(o_totalprice) then cast(nullif(o_totalprice, 0) as bigint) end
              as varchar))),
            count(*) filter (where o_totalprice <> floor(o_totalprice)) from orders
          union all select 'o_orderdate', max(length(cast(o_orderdate as varchar))), null from orders
          union all select 'o_orderpriority', max(length(o_orderpriority)), null from orders)""",
    "proj_rename": "select o_orderkey as sale_id, o_custkey as client_id, o_orderstatus as status from orders",
    "proj_cast_double": "select o_orderkey, cast(cast(o_totalprice as decimal(18,2)) as double) as price from orders",
    "proj_source_tag": "select o_orderkey, 'north' as source from orders",
    "unit_key": f"select p_partkey, n_name || ' ' || p_name as unit_key from {PARTS}",
    "unit_key_staged": f"""
        select p_partkey, coalesce(n_name, 'NONE') || ' ' || p_name ||
          case when n_name in ('NATION_3', 'NATION_8') then ' ' || p_type else '' end as unit_key
        from {PARTS}""",
    "prefix_reference": "select c_custkey, 'REF_' || nullif(c_mktsegment, 'BUILDING') as reference from customer",
    "financed_months": "select l_orderkey, count(*) + 1 as financed_months from lineitem group by l_orderkey",
    "down_payment_capped": """
        select o_orderkey, cast(case when d > c then c else d end as double) as down_payment
        from (
          select o_orderkey,
            case when o_orderpriority <> '5-LOW' then cast(o_totalprice as decimal(18,2)) end as c,
            case when o_orderstatus <> 'P' then 200000 end as d
          from orders)""",
    "promise_if_overdue": f"""
        select l_orderkey, case when min(l_shipdate) < {AS_OF} then max(cast(l_shipdate as date)) end as promised_on
        from lineitem group by l_orderkey""",
    "case_label_by_group": "select p_partkey, case p_type when 'ECONOMY' then 'share' when 'SMALL' then 'unit'"
    " when 'LARGE' then 'office' end as model from part",
    "case_measure_by_group": f"select p_partkey, {SIZE} as size from part",
    "unit_price_safe_div": """
        select l_orderkey, l_linenumber, l_partkey,
          case when l_quantity > 10 and l_quantity <> 50 then l_extendedprice / (l_quantity - 10) else 0 end
            as unit_price
        from lineitem""",
    "fund_split": f"""
        select o_orderkey, cast(coalesce(fee, 0) as double) as fee_amount,
          cast(coalesce(reserve, 0) as double) as reserve_amount, cast(coalesce(fund, 0) as double) as fund_amount
        from orders o {FUNDS}""",
    "future_funds": f"""
        select o_orderkey, cast(case when fee is null and reserve is null and fund is null
          then cast(o_totalprice as decimal(18,2)) else 0 end as double) as future_funds
        from orders o {FUNDS}""",
    "latest_in_month_amount": f"""
        select c_custkey, cast(case when o_orderdate is null then null
          when {MONTH.format("o_orderdate")} then o_totalprice else 0 end as double) as month_amount
        from customer left join (
          select * from orders where o_orderkey in (select max(o_orderkey) from orders group by o_custkey)
        ) on o_custkey = c_custkey""",
    "filter_current_month": "select o_orderkey, o_orderdate, o_totalprice from orders"
    " where year(o_orderdate) = 1998 and month(o_orderdate) = 7",
    "filter_current_month_text": """
        select o_orderkey, o_totalprice, case o_orderkey % 5
            when 1 then strftime(o_orderdate, '%Y-%-m-%-d') when 2 then strftime(o_orderdate, '  %Y-%m-%d ')
            when 3 then strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') else strftime(o_orderdate, '%Y-%m-%d') end as day
        from orders where o_orderkey % 5 <> 0 and year(o_orderdate) = 1998 and month(o_orderdate) = 7""",
    "agg_milestone_date_text": """
        select user_id, min(cast(ts as date)) filter (where event_type ilike 'sign%' and event_id % 5 <> 0)
            as reached_on
        from events group by user_id""",
    "filter_status_eq": "select o_orderkey, o_orderstatus from orders where o_orderstatus = 'O'",
    "filter_in_list": "select o_orderkey, o_orderstatus from orders where o_orderstatus in ('F', 'P')",
    "filter_not_like_any": """
        select * from (select p_partkey, nullif(p_name, 'blue bolt') as name from part)
        where name not like '%widget%' and name not like '%anvil%' and name not like '%old%'""",
    "filter_not_in": """
        select * from (select n_nationkey, nullif(n_name, 'NATION_1') as name from nation)
        where name not in ('NATION_2', 'NATION_3')""",
    "filter_not_and": """
        select * from (select o_orderkey, nullif(o_orderstatus, 'P') as status, o_orderpriority from orders)
        where not (status = 'O' and o_orderpriority = '5-LOW')""",
    "filter_not_null": """
        select o_orderkey, l_returnflag from orders left join lineitem on l_orderkey = o_orderkey
        where l_returnflag is not null""",
    "filter_neq": """
        select * from (select n_nationkey, nullif(n_name, 'NATION_1') as name from nation) where name <> 'NATION_4'""",
    "filter_prefix_like": "select p_partkey, upper(p_name) as name from part where p_name ilike 'small%'",
    "filter_before_fold": f"""
        select doc_id, {fold("text")} as folded from documents
        where text not like '%informacion%' and text not like '%si %'""",
    "join_lookup_chain": """
        select o_orderkey, o_custkey, c_name as client, c_nationkey as nation_id, n_name as nation,
          n_regionkey as region_id, r_name as region
        from orders left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey
        left join region on r_regionkey = n_regionkey""",
    "join_composite_key": f"""
        select p.l_orderkey, p.l_linenumber, p.amount, f.l_partkey as flow_part
        from (select l_orderkey, l_linenumber, cast(sum({PRICE}) as double) as amount from lineitem group by all) p
        left join (select * from lineitem where l_returnflag = 'R') f
          on f.l_orderkey = p.l_orderkey and f.l_linenumber = p.l_linenumber""",
    "join_latest_row": """
        select o.o_custkey, o.o_orderkey, o.o_orderdate as paid_at, o.o_totalprice as amount
        from orders o join (
          select o_custkey, max(o_orderkey) as max_id from orders where o_orderstatus = 'O' group by o_custkey
        ) m on o.o_orderkey = m.max_id
        where o.o_orderstatus = 'O'""",
    "join_left_where_right": """
        select l_orderkey, l_linenumber, l_partkey, l_shipdate, p_type as kind
        from lineitem left join part on p_partkey = l_partkey where p_type = 'PROMO'""",
    "join_dimension_text": f"""
        select c_custkey, c.raw_name, b.brand, b.development
        from (
          select c_custkey, case when c_nationkey < 20 then 'NATION_' || c_nationkey else 'UNKNOWN' end as raw_name
          from customer) c
        left join {BRAND} b on b.raw_name = c.raw_name""",
    "join_preaggregated": f"""
        select o_orderkey, total, last_number from orders left join (
          select l_orderkey, cast(sum({PRICE}) as double) as total, max(l_linenumber) as last_number
          from lineitem group by l_orderkey) on l_orderkey = o_orderkey""",
    "join_correlated_top1": f"""
        select k.sale_id, (
          select cast({BALANCE} as double) from lineitem
          where l_orderkey = k.sale_id and {AHEAD}
          order by {DUE}, l_linenumber, {BALANCE} limit 1
        ) as next_due_balance
        from (select distinct l_orderkey as sale_id from lineitem) k""",
    "join_coowner_key": f"""
        select o_orderkey as sale_id, coowners from orders left join ({COOWNERS}) c
        on c.owner_key = case when o_orderpriority in ('2-HIGH', '3-MEDIUM') then o_custkey else o_orderkey end""",
    "join_one_to_many_detail": """
        select o_orderkey, o_totalprice, l_linenumber, l_partkey
        from orders left join lineitem on l_orderkey = o_orderkey""",
    "agg_overdue_balance": per_sale("overdue_balance", double(OVERDUE)),
    "agg_first_overdue": per_sale("first_overdue_on", FIRST_OVERDUE),
    "agg_required_total": per_sale("required_total", double(REQUIRED)),
    "agg_overdue_billed": per_sale("overdue_billed", double(OVERDUE_BILLED)),
    "agg_next_due_date": per_sale("next_due_on", NEXT_ON),
    "agg_next_due_number": per_sale("next_due_number", NEXT_NUMBER),
    "aging_one_pass": f"""
        select l_orderkey as sale_id, {FIRST_OVERDUE} as first_overdue_on, {double(OVERDUE)} as overdue_balance,
          {double(REQUIRED)} as required_total, {double(OVERDUE_BILLED)} as overdue_billed,
          {NEXT_ON} as next_due_on, {NEXT_NUMBER} as next_due_number, {DUE_DAY} as due_day,
          {double(KIND_AMOUNT)} as instalment_amount
        from lineitem group by l_orderkey""",
    "agg_max_id": "select o_custkey, max(o_orderkey) as max_id from orders where o_orderstatus = 'O' group by o_custkey",
    "agg_latest_promise": "select user_id as sale_id, max(cast(ts as date)) filter (where event_type <> 'error')"
    " as promised_on from events group by user_id",
    "agg_due_day": per_sale("due_day", DUE_DAY),
    "agg_any_value": """
        select l_orderkey, arg_min(l_suppkey, {'d': l_shipdate, 'n': l_linenumber, 's': l_suppkey}) as account
        from lineitem group by l_orderkey""",
    "agg_milestone_date": "select user_id, min(cast(ts as date)) filter (where event_type ilike 'sign%') as reached_on"
    " from events group by user_id",
    "agg_distinct_ordered_list": """
        select l_orderkey, string_agg(distinct f, ', ' order by f) as concepts
        from (select l_orderkey, nullif(l_returnflag, 'A') as f from lineitem) group by l_orderkey""",
    "agg_coowner_list": """
        select l_orderkey as owner_key, string_agg(name, ', ' order by name) as coowners
        from (
          select l_orderkey, case when s_nationkey <> 0 then split_part(s_name, '#', 1) || ' S.-' ||
            split_part(s_name, '#', 2) || ' K' || s_nationkey end as name
          from lineitem join supplier on l_suppkey = s_suppkey)
        group by l_orderkey""",
    "agg_coowner_chunks": """
        with counted as (
          select l_orderkey, split_part(s_name, '#', 1) || ' S.-' || split_part(s_name, '#', 2) || ' K' || s_nationkey as name,
            count(*) as n
          from lineitem join supplier on l_suppkey = s_suppkey group by all
        ), placed as (
          select *, (row_number() over (partition by l_orderkey order by name) - 1) // 2 as chunk from counted
        )
        select l_orderkey as owner_key, chunk, string_agg(name, ', ' order by name) as names,
          string_agg(n::varchar, ', ' order by name) as counts
        from placed group by l_orderkey, chunk""",
    "agg_having": f"""
        select l_orderkey, cast(sum({PRICE}) as double) as total from lineitem
        group by l_orderkey having sum({PRICE}) > 300000""",
    "agg_payment_rollup": f"""
        select p.l_orderkey * 10 + p.l_linenumber as payment_id, p.l_orderkey as sale_id,
          cast(cast(p.l_tax as decimal(18,2)) as double) as surcharge, min(p.l_shipdate) as paid_on,
          min(cast(p.l_shipdate as date) - cast(p.l_quantity as int)) as created_on,
          min(p.l_extendedprice) as amount, max('instalment-' || lower(p.l_linestatus) || ' paid') as concept,
          max('F-' || p.l_partkey) as folio,
          string_agg(distinct f.l_returnflag, ', ' order by f.l_returnflag) as flow_concepts
        from lineitem p left join lineitem f on f.l_orderkey = p.l_orderkey and f.l_linenumber = p.l_linenumber
        group by p.l_orderkey, p.l_linenumber, p.l_tax""",
    "agg_concept_rollup": f"""
        select p.l_orderkey * 10 + p.l_linenumber as payment_id, p.l_orderkey as sale_id,
          cast(cast(p.l_tax as decimal(18,2)) as double) as surcharge, min(p.l_shipdate) as paid_on,
          min(cast(p.l_shipdate as date) - cast(p.l_quantity as int)) as created_on,
          max('instalment-' || lower(p.l_linestatus) || ' paid') as concept, max('F-' || p.l_partkey) as folio,
          f.flow_concept, cast(min(f.flow_amount) as double) as amount
        from lineitem p left join (
          select l_orderkey, l_linenumber, l_returnflag as flow_concept, {NET} as flow_amount from lineitem
        ) f on f.l_orderkey = p.l_orderkey and f.l_linenumber = p.l_linenumber
        group by p.l_orderkey, p.l_linenumber, p.l_tax, f.flow_concept""",
    "agg_group_all_dedupe": "select l_orderkey, l_returnflag, l_linestatus from lineitem group by all",
    "window_max_distinct": """
        select distinct o_custkey, max(o_orderdate) over (partition by o_custkey) as last_paid_at from orders""",
    "sort_created_asc": """
        select o_orderkey, case when o_orderstatus <> 'P' then o_orderdate end as created_on
        from orders order by created_on asc nulls first, o_orderkey""",
    "top1_per_key": """
        select l_orderkey, l_shipdate as first_at, l_partkey as first_part
        from lineitem
        qualify row_number() over (
          partition by l_orderkey order by l_shipdate, l_linenumber, l_partkey, l_extendedprice) = 1""",
    "union_sources": "select o_orderkey as sale_id, o_totalprice as price, o_orderpriority as source from orders",
    "person_name_words": f"select c_custkey, {name_words('first', 'last1', 'last2')} as name from {PEOPLE}",
    "person_name_documents": f"""
        select doc_id, {name_words("source", "text", "nullif(lang, 'de')")} as name from documents""",
    "person_name_strict": f"""
        select c_custkey, {name_strict("first", "last1", "last2")} as client,
          {name_strict("first", "last1", "last2", "-")} as seller from {PEOPLE}""",
    "title_case": f"select p_partkey, {title_space("upper(p_name || ' ' || p_type)")} as title from part",
    "title_case_punct": f"select doc_id, {title('text')} as title from documents",
    "strip_chars": f"""
        select p_partkey, {strip("p_name || '-.' || p_type || '-.' || p_brand")} as stripped from part""",
    "strip_tokens": """
        select p_partkey, trim(replace(replace(replace(replace(p_name, 'red', ''), 'bolt', ''), 'mall', ''), '.', ''))
          as stripped
        from part""",
    "strip_tokens_regex": r"""
        select p_partkey, trim(regexp_replace(p_name || '.' || p_type, 'red|bolt|mall|\.', '', 'g')) as stripped
        from part""",
    "fold_accents": """
        select doc_id, replace(replace(replace(replace(replace(replace(text, 'á', 'a'), 'é', 'e'), 'í', 'i'),
          'ó', 'o'), 'ú', 'u'), 'ñ', 'n') as folded
        from documents""",
    "clean_zero_date": """
        select o_orderkey, case when o_orderpriority in ('2-HIGH', '3-MEDIUM') then cast(o_orderdate as date) end
          as clean_on
        from orders""",
    "to_date": "select o_orderkey, cast(o_orderdate as date) as order_on from orders",
    "date_parts": """
        select o_orderkey, cast(year(o_orderdate) as int) as year_no, cast(month(o_orderdate) as int) as month_no,
          cast(day(o_orderdate) as int) as day_no
        from orders""",
    "days_overdue": per_sale("days_overdue", f"cast(date_diff('day', {FIRST_OVERDUE}, {AS_OF}) as int)"),
    "concat_ws_nonblank": """
        select c_custkey, case when c_nationkey = 3 then null else split_part(c_name, '#', 1) || ' ' || c_mktsegment ||
          case when c_acctbal > 0 then ' ' || split_part(c_name, '#', 2) else '' end end as name
        from customer""",
    "coalesce_zero": f"""
        select o_orderkey, cast(coalesce(total, 0) as double) as total from orders left join (
          select l_orderkey, sum({PRICE}) as total from lineitem group by l_orderkey) on l_orderkey = o_orderkey""",
    "trim_text": f"""
        select doc_id, {trim("'  ' || chr(9) || text || ' ' || chr(10) || ' '")} as trimmed from documents""",
    "split_transform_join": f"select doc_id, {title_space('text')} as title from documents",
    "normalise_by_name": f"""
        select o_orderkey, cast(0 as bigint) as o_custkey, {cents("o_totalprice")} as o_totalprice,
          {parse_date("d")} as order_date, o_orderstatus,
          case when o_orderpriority = '5-LOW' then '' else o_orderpriority end as o_orderpriority,
          o_orderdate as untouched
        from (select *, {DIRTY_DATE} as d from orders)""",
    "normalise_date": f"select o_orderkey, {parse_date('d')} as order_date from (select *, {DIRTY_DATE} as d from orders)",
    "normalise_money": f"""
        select l_orderkey, l_linenumber, l_partkey, l_suppkey, {money_text("t")} as amount,
          {cents("l_extendedprice * l_discount")} as net_amount
        from (select *, {DIRTY_MONEY} as t from lineitem)""",
    "normalise_int": f"""
        select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, {to_int("t")} as number
        from (select *, {DIRTY_INT} as t from lineitem)""",
    "normalise_int_rejects": "select count(*) as number from lineitem where l_linenumber = 4",
    "normalise_text": """
        select c_custkey, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as segment_text,
          cast(c_nationkey as varchar) as nation_text
        from customer""",
    "column_width_profile": """
        select "column", least(50.0::double, greatest(8.0::double,
          (greatest(coalesce(longest, 0), length("column")) + 2) * 1.1::double)) as width
        from (
          select 'o_orderkey' as "column", max(length(cast(nullif(o_orderkey, 0) as varchar))) as longest from orders
          union all select 'o_custkey', max(length(cast(nullif(o_custkey, 0) as varchar))) from orders
          union all select 'o_orderstatus', max(length(o_orderstatus)) from orders
          union all select 'o_totalprice', max(length(regexp_replace(cast(o_totalprice as varchar), '\\.0$', '')))
            from orders
          union all select 'o_orderdate', max(length(cast(o_orderdate as varchar))) from orders
          union all select 'o_orderpriority', max(length(o_orderpriority)) from orders)""",
    "report_overdue_portfolio": OVERDUE_PORTFOLIO,
    "report_statement_flat": STATEMENT_FLAT,
    "report_income_flat": INCOME_FLAT,
    "report_income_fund_split": FUND_SPLIT,
    "report_statement_sales": statement_sales(),
    "report_statement_coowners": statement_sales("coowner"),
    "report_income_sales": income_sales("payment"),
    "report_income_by_concept": income_sales("concept"),
    "report_statement_sales_systems": statement_sales(),
    "report_income_sales_systems": income_sales("payment"),
    "report_income_by_concept_systems": income_sales("concept"),
}
