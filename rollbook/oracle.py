"""The same queries as single DuckDB statements, written apart from the Spark code.

Only the fixture SQL is shared. Each statement is a chain of WITH blocks; the blocks a
query needs are listed next to it.
"""

from __future__ import annotations

from rollbook import fixtures

_IDENTITY = (
    "employee_id source_employee_id company_origin first_name last_name full_name email department "
    "department_standardized job_title manager_id employment_type country jurisdiction hire_date "
    "source_system"
).split()
_PAY = (
    "salary_original currency pay_frequency compensation_effective_date salary_usd_annual"
).split()
_BEN = "benefits_enrolled benefits_enrollment_date".split()
_CANONICAL = _IDENTITY[:15] + _PAY + _BEN + ["source_system"]
_GOLDEN = _IDENTITY + _PAY + _BEN + ["source_systems", "dedup_method"]

_TYPES = {
    "hire_date": "timestamp",
    "compensation_effective_date": "timestamp",
    "benefits_enrollment_date": "timestamp",
    "salary_usd_annual": "double",
    "benefits_enrolled": "boolean",
}


def _record(typed: bool, **values: str) -> str:
    """A select list with all canonical columns; those not given are null."""
    def one(c: str) -> str:
        kind = _TYPES.get(c, "varchar") if typed or c == "benefits_enrolled" else "varchar"
        return f"cast({values.get(c, 'null')} as {kind}) as {c}"

    return ", ".join(one(c) for c in _CANONICAL)


def _id(value: str, prefix: str) -> str:
    digits = f"regexp_extract({value}, '[0-9]+')"
    short = f"ltrim({digits}, '0')"
    return (
        f"case when {digits} <> '' then {prefix} || '-' || "
        f"case when length({short}) >= 6 then {short} else lpad({short}, 6, '0') end end"
    )


def _name(value: str) -> str:
    runs = f"regexp_extract_all(lower(trim({value})), '[a-z]+|[^a-z]+')"
    return (
        f"case when trim({value}) <> '' then "
        f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || r[2:]), '') end"
    )


def _usd(value: str) -> str:
    factors = " ".join(
        f"when '{currency}|{period}' then {rate * times / 100:.2f}"
        for currency, rate in (("USD", 100), ("EUR", 108), ("GBP", 127))
        for period, times in (
            ("annual", 1), ("monthly", 12), ("bi-weekly", 26), ("biweekly", 26), ("bi weekly", 26)
        )
    )
    amount = f"cast({_bare(value)} as decimal(24,6))"
    key = "upper(trim(currency)) || '|' || lower(trim(pay_frequency))"
    return (
        f"cast(round({amount} * cast(case {key} {factors} end as decimal(10,4)), 2) as double)"
    )


def _bare(value: str) -> str:
    plain = f"trim(replace(replace(replace({value}, '$', ''), ',', ''), '€', ''))"
    return f"case when regexp_matches({plain}, '^[0-9.+-]+$') then {plain} end"


_TYPE_CASE = (
    "case lower(trim(employment_type)) when 'ft' then 'Full-Time' when 'full time' then 'Full-Time' "
    "when 'full-time' then 'Full-Time' when 'pt' then 'Part-Time' when 'part time' then 'Part-Time' "
    "when 'part-time' then 'Part-Time' when 'contract' then 'Contractor' "
    "when 'contractor' then 'Contractor' when 'ct' then 'Contractor' end"
)

_NO_DIGIT = "not regexp_matches({}, '[0-9]')"
_BAD_DATE = (
    "case when try_cast(substr({0}, 1, 10) as date) is null then 'unparsed' "
    "when try_cast(substr({0}, 1, 10) as date) not between date '1970-01-01' and date '2024-12-31' then 'out of range' end"
)

_A = "employee_id first_name last_name email department job_title hire_date country employment_type manager_id".split()

_BLOCKS: dict[str, tuple[str, str]] = {}  # name: (blocks it needs, sql)


def _block(name: str, needs: str, sql: str) -> None:
    _BLOCKS[name] = (needs, sql)


_block("fx_a", "", fixtures.HRIS_A)
_block("fx_b", "", fixtures.HRIS_B)
_block("fx_pay", "", fixtures.PAYROLL)
_block("fx_ben", "", fixtures.BENEFITS)
_block("fx_map", "", fixtures.DEPARTMENT_MAPPING)

_ALIGN_A = _record(
    False,
    **{c: c for c in _A},
    source_employee_id="employee_id",
    company_origin="'GlobalTech'",
    full_name="concat_ws(' ', trim(first_name), trim(last_name))",
    source_system="'globaltech_hris'",
)
_ALIGN_B = _record(
    False,
    employee_id="employee_identifier",
    source_employee_id="employee_identifier",
    company_origin="'AcquiredCo'",
    first_name="first_name",
    last_name="last_name",
    full_name="first_name || ' ' || last_name",
    email="email",
    department="department",
    job_title="role",
    country="location",
    hire_date="hire_timestamp",
    employment_type="type",
    manager_id="manager_employee_id",
    source_system="'acquiredco_hris'",
)
_ALIGN_PAY = _record(
    False,
    employee_id="employee_id",
    source_employee_id="employee_id",
    company_origin="source",
    salary_original="base_salary",
    currency="currency",
    pay_frequency="pay_frequency",
    compensation_effective_date="effective_date",
    source_system="'payroll'",
)
_ALIGN_BEN = _record(
    False,
    employee_id="employee_id",
    source_employee_id="employee_id",
    company_origin="'GlobalTech'",
    benefits_enrolled="true",
    benefits_enrollment_date="enrollment_date",
    source_system="'benefits'",
)

_PREFIX = "case company_origin when 'GlobalTech' then 'GT' when 'AcquiredCo' then 'AC' end"
_FIRST, _LAST = _name("first_name"), _name("last_name")
_CLEAN_IDENTITY = _record(
    True,
    employee_id=_id("employee_id", _PREFIX),
    source_employee_id="source_employee_id",
    company_origin="company_origin",
    first_name=_FIRST,
    last_name=_LAST,
    full_name=f"nullif(concat_ws(' ', {_FIRST}, {_LAST}), '')",
    email="lower(trim(email))",
    department="department",
    department_standardized="standard_department",
    job_title="job_title",
    manager_id=_id("manager_id", _PREFIX),
    employment_type=_TYPE_CASE,
    country="country",
    hire_date="cast(substr(hire_date, 1, 10) as timestamp)",
    source_system="a.source_system",
)
_block("aligned_hris", "fx_a fx_b",
       f"select {_ALIGN_A}, row_ord from fx_a union all "
       f"select {_ALIGN_B}, cast(null as integer) from fx_b")
_block("cleaned_hris", "aligned_hris fx_map",
       f"select {_CLEAN_IDENTITY}, row_ord from aligned_hris a left join fx_map m "
       "on m.source_system = a.source_system "
       "and lower(trim(m.source_department)) = lower(trim(a.department))")
_CLEAN_PAY = _record(
    True,
    employee_id=_id("employee_id", "case source when 'GlobalTech' then 'GT' else 'AC' end"),
    source_employee_id="employee_id",
    company_origin="source",
    salary_original="base_salary",
    currency="currency",
    pay_frequency="pay_frequency",
    compensation_effective_date="effective_date",
    salary_usd_annual=_usd("base_salary"),
    source_system="'payroll'",
)
_block("cleaned_pay", "fx_pay", f"select {_CLEAN_PAY}, row_ord from fx_pay")
_CLEAN_BEN = _record(
    True,
    employee_id=_id("employee_id", "'GT'"),
    source_employee_id="employee_id",
    company_origin="'GlobalTech'",
    benefits_enrolled="true",
    benefits_enrollment_date="enrollment_date",
    source_system="'benefits'",
)
_block("cleaned_ben", "fx_ben", f"select {_CLEAN_BEN}, row_ord from fx_ben")
_block("combined", "cleaned_hris cleaned_pay cleaned_ben",
       "select * from cleaned_hris union all select * from cleaned_pay "
       "union all select * from cleaned_ben")

_SCORE = " + ".join(
    f"(case when {c} is null then 0 else 1 end)"
    for c in ("full_name", "email", "department", "job_title", "manager_id", "employment_type",
              "country", "hire_date")
)
_I = ", ".join(_IDENTITY)
_block("ranked", "cleaned_hris",
       f"select *, row_number() over (partition by employee_id order by {_SCORE} desc, "
       "source_system, row_ord nulls first) as rn, "
       "count(*) over (partition by employee_id) as copies from cleaned_hris")
_block("survivors", "ranked", f"select {_I} from ranked where rn = 1")
_block("pay_latest", "cleaned_pay",
       f"select employee_id, {', '.join(_PAY)} from cleaned_pay qualify row_number() over "
       "(partition by employee_id order by compensation_effective_date desc nulls last, row_ord) = 1")
_block("ben_summary", "cleaned_ben",
       "select employee_id, true as benefits_enrolled, "
       "min(benefits_enrollment_date) as benefits_enrollment_date from cleaned_ben "
       "where employee_id is not null group by employee_id")
_block("provenance", "combined",
       "select employee_id, string_agg(distinct source_system, '|' order by source_system) "
       "as source_systems from combined where employee_id is not null group by employee_id")
_block("golden", "survivors pay_latest ben_summary provenance",
       f"select {', '.join('s.' + c for c in _IDENTITY)}, {', '.join('p.' + c for c in _PAY)}, "
       "coalesce(b.benefits_enrolled, false) as benefits_enrolled, b.benefits_enrollment_date, "
       "coalesce(v.source_systems, s.source_system) as source_systems, "
       "'exact_employee_id' as dedup_method from survivors s "
       "left join pay_latest p using (employee_id) left join ben_summary b using (employee_id) "
       "left join provenance v using (employee_id)")

_C = ", ".join(_CANONICAL)
_GHOST = "employee_id is null or employee_id not in (select employee_id from survivors)"
_block("ghosts", "cleaned_pay cleaned_ben survivors",
       f"select {_C} from cleaned_pay where {_GHOST} union all "
       f"select {_C} from cleaned_ben where {_GHOST}")


def _lcs(a: str, b: str) -> str:
    """Longest common subsequence of two strings, row by row."""
    chars_a = f"list_transform(string_split({a}, ''), lambda c: [ord(c)])"
    places = f"list_transform(range(1, length({b}) + 1), lambda j: [j])"
    cell = (
        f"case when ord(substr({b}, y[1], 1)) = x[1] then row_[y[1]] + 1 "
        "else greatest(acc[y[1]], row_[y[1] + 1]) end"
    )
    row = f"list_reduce({places}, lambda acc, y: list_append(acc, {cell}), [0::bigint])"
    zeros = f"list_transform(range(length({b}) + 1), lambda z: 0::bigint)"
    return f"list_max(list_reduce({chars_a}, lambda row_, x: {row}, {zeros}))"


def _tokens(value: str) -> str:
    return f"array_to_string(list_sort(list_filter(string_split({value}, ' '), lambda w: w <> '')), ' ')"


def _sides(*columns: str) -> str:
    return ", ".join(f"{s[0]}.{c} as {s}_{c}" for c in columns for s in ("left", "right"))


_GAP = "cast(abs(date_diff('day', r.hire_date, l.hire_date)) as integer)"
_PAIR = _sides("employee_id", "company_origin", "full_name")
_PAIR_TAIL = _sides("email", "hire_date")
_block("same_name", "golden",
       f"select 'same_full_name_hire_date_window' as match_type, {_PAIR}, {_PAIR_TAIL}, "
       f"{_GAP} as hire_date_gap_days, true as review_required from golden l join golden r "
       "on l.full_name = r.full_name and l.company_origin < r.company_origin "
       f"where {_GAP} <= 30")
_block("near", "golden",
       f"select {_PAIR}, {_PAIR_TAIL}, {_GAP} as hire_date_gap_days, "
       f"{_tokens('l.full_name')} as a, {_tokens('r.full_name')} as b "
       "from golden l join golden r on l.company_origin = 'AcquiredCo' "
       "and r.company_origin = 'GlobalTech' and r.hire_date between "
       "l.hire_date - interval 30 day and l.hire_date + interval 30 day")
_block("measured", "near",
       f"select *, length(a) + length(b) as n, {_lcs('a', 'b')} as lcs from near")
_SCORED = "(1.0::double - (n - lcs * 2)::double / n) * 100.0::double"
_PAIR_OUT = ", ".join(
    f"{s}_{c}" for c in ("employee_id", "company_origin", "full_name") for s in ("left", "right")
)
_TAIL_OUT = ", ".join(f"{s}_{c}" for c in ("email", "hire_date") for s in ("left", "right"))
_block("fuzzy", "measured",
       f"select 'fuzzy_name_hire_date_window' as match_type, {_PAIR_OUT}, "
       f"{_SCORED} as name_similarity_score, {_TAIL_OUT}, hire_date_gap_days, "
       "true as review_required from measured where 200 * lcs >= 88 * n")
_block("probable", "same_name fuzzy",
       "select * from (select *, 1 as p from fuzzy union all by name "
       "select *, 0 as p, null as name_similarity_score from same_name) "
       "qualify row_number() over (partition by left_employee_id, right_employee_id "
       "order by p, hire_date_gap_days) = 1")

_RULES = (
    ("employee_id_not_null", "employee_id must not be null", "employee_id is not null"),
    ("employee_id_unique", "employee_id should be unique across the dataset",
     "count(*) over (partition by employee_id) = 1"),
    ("employee_id_format", "employee_id must match GT-000001 or AC-000001 format",
     "regexp_full_match(employee_id, '(GT|AC)-[0-9]{6}')"),
    ("full_name_not_null", "full_name must not be null", "full_name is not null"),
    ("email_not_null", "email must not be null", "email is not null"),
    ("email_format", "email must be in a valid format",
     "regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+')"),
    ("company_origin_allowed", "company_origin must be GlobalTech or AcquiredCo",
     "company_origin in ('GlobalTech', 'AcquiredCo')"),
    ("employment_type_allowed", "employment_type must be Full-Time, Part-Time, or Contractor",
     "employment_type is null or employment_type in ('Full-Time', 'Part-Time', 'Contractor')"),
    ("department_standardized_not_null", "department_standardized must not be null",
     "department_standardized is not null"),
    ("hire_date_not_null", "hire_date must not be null", "hire_date is not null"),
    ("hire_date_plausible_range", "hire_date must be between 1990-01-01 and today",
     "hire_date between timestamp '1990-01-01' and timestamp '2024-12-31'"),
    ("salary_usd_annual_range",
     "salary_usd_annual must be between 20,000 and 2,000,000 when present",
     "salary_usd_annual is null or salary_usd_annual between 20000 and 2000000"),
    ("manager_id_referential_integrity",
     "manager_id must refer to an employee_id in the golden dataset when present",
     "manager_id is null or manager_id in (select employee_id from golden)"),
    ("benefits_enrolled_boolean", "benefits_enrolled must be boolean",
     "benefits_enrolled is not null"),
)
_block("flags", "golden",
       "select " + ", ".join(f"coalesce({p}, false) as f{i}" for i, (_, _, p) in enumerate(_RULES))
       + " from golden")
_block("report", "flags", " union all ".join(
    f"select '{name}' as \"check\", '{text}' as description, count(*) as total, "
    f"count(*) filter (f{i}) as passed, count(*) filter (not f{i}) as failed, "
    f"floor((count(*) filter (f{i}) * 20000 + count(*)) / (2 * count(*))) / 100 as pass_rate, "
    f"case when bool_and(f{i}) then 'PASS' else 'FAIL' end as status from flags"
    for i, (name, text, _) in enumerate(_RULES)
))


def _failed(check: str, select: str, source: str) -> str:
    name, text, predicate = next(r for r in _RULES if r[0] == check)
    return (
        f"select * exclude (ok) from (select {select}, '{name}' as failed_check, "
        f"'{text}' as failed_check_description, coalesce({predicate}, false) as ok "
        f"from {source}) where not ok"
    )


_DAYS = "date_diff('day', hire_date, timestamp '2024-12-31')"
_block("tenures", "golden", f"select {_DAYS} as d from golden where hire_date is not null")
_block("tenure_range", "tenures", "select min(d) as lo, max(d) as hi from tenures")
_block("salary_cents", "golden",
       "select employment_type, cast(round(cast(salary_usd_annual as decimal(28,2)) * 100) as bigint) "
       "as c, row_number() over (partition by employment_type order by salary_usd_annual) - 1 as rk, "
       "count(*) over (partition by employment_type) as n from golden "
       "where salary_usd_annual is not null and employment_type is not null")


def _quartile(q: int) -> str:
    lower = f"max(case when rk = {q} * (n - 1) // 4 then c end)"
    upper = f"max(case when rk = least({q} * (n - 1) // 4 + 1, n - 1) then c end)"
    return f"4 * {lower} + ({upper} - {lower}) * (max({q} * (n - 1)) % 4) as q{q}"


_block("quartiles", "salary_cents",
       "select employment_type, count(*) as employee_count, "
       f"{', '.join(_quartile(q) for q in (1, 2, 3))} from salary_cents group by employment_type")
_INSIDE = "8 * c between 2 * q1 - 3 * (q3 - q1) and 2 * q3 + 3 * (q3 - q1)"

_DATE = "cast(o_orderdate as date)"


def _final(needs: str, sql: str) -> str:
    done: list[str] = []

    def add(name: str) -> None:
        if name in done:
            return
        for need in _BLOCKS[name][0].split():
            add(need)
        done.append(name)

    for name in needs.split():
        add(name)
    blocks = ", ".join(
        f"{n} as materialized ({_BLOCKS[n][1].strip()})" for n in done
    )
    return f"with {blocks} {sql}" if blocks else sql


_MESSY_FIRST = (
    "case c_custkey % 4 when 0 then {t} || '-' || {t} when 1 then {t} || '''' || {t} "
    "when 2 then null else 'Élo' || lower(p_type) || ' 3Rd' end"
).format(t="(upper(p_type[1]) || lower(p_type[2:]))")
_SEG = "(upper(c_mktsegment[1]) || lower(c_mktsegment[2:]))"
_MESSY_LAST = f"case c_custkey % 3 when 0 then null when 1 then {_SEG} else 'X_' || {_SEG} end"


_PEOPLE = (
    "select employee_identifier, first_name as name_first, last_name as name_last, "
    "first_name || ' ' || last_name as name_full, email as contact_email, "
    "department as assignment_department, role as assignment_role, "
    "location as assignment_location, hire_timestamp as assignment_hire_timestamp, "
    "type as employment_type, 'active' as employment_status, manager_employee_id, "
    "'acquiredco_hris' as source_system from fx_b"
)

# Files hold the rows of the query they are written from.
_READ_BACK = {
    "q_sink_duplicate_emails": "q_duplicate_emails",
    "q_sink_duplicate_hris": "q_hris_duplicate_review",
    "q_sink_matches": "q_match_export",
    "q_sink_salary_failures": "q_salary_failures",
    "q_sink_report": "q_validation_report",
}


def statements() -> dict[str, str]:
    found = _statements()
    found |= {name: found[source] for name, source in _READ_BACK.items()}
    found["q_gate_failures"] = (
        f'select "check", failed from ({found["q_validation_report"]}) where status = \'FAIL\''
    )
    return found


def _statements() -> dict[str, str]:
    plain_id = "lpad(cast({} as varchar), 6, '0')"
    return {
        "q_align_hris": _final("aligned_hris", f"select {_C} from aligned_hris"),
        "q_align_payroll": _final("fx_pay", f"select {_ALIGN_PAY} from fx_pay"),
        "q_align_benefits": _final("fx_ben", f"select {_ALIGN_BEN} from fx_ben"),
        "q_clean_ids": f"""
select c_custkey as row_id,
  case c_custkey % 8 when 0 then 'GT-' || {plain_id.format('c_custkey')}
    when 1 then 'AC-' || cast(c_custkey + 1000000 as varchar)
    when 2 then 'GT-' || {plain_id.format('c_custkey')}
    when 4 then 'GT-000000'
    when 6 then 'GT-' || cast(c_custkey + 990000 as varchar) end as employee_id,
  case when c_custkey % 10 >= 2 and c_custkey % 4 <> 3 then
    (case when c_custkey % 4 = 1 then 'AC-' else 'GT-' end)
    || {plain_id.format('c_nationkey')} end as manager_id
from customer""",
        "q_clean_names": f"""
select row_id, first_name, last_name, email,
  nullif(concat_ws(' ', first_name, last_name), '') as full_name
from (select c_custkey as row_id, {_MESSY_FIRST} as first_name, {_MESSY_LAST} as last_name,
  case when c_custkey % 7 <> 0 then lower(c_name) || '@example.com' end as email
from customer join part on p_partkey = c_custkey)""",
        "q_clean_types_dates": f"""
select o_orderkey as row_id,
  case o_orderkey % 7 when 0 then 'Full-Time' when 1 then 'Full-Time' when 2 then 'Part-Time'
    when 3 then 'Part-Time' when 4 then 'Contractor' end as employment_type,
  case o_orderkey % 9 when 0 then cast({_DATE} as timestamp)
    when 1 then cast({_DATE} as timestamp) + interval '28 hours 30 minutes'
    when 2 then cast({_DATE} as timestamp) when 3 then cast({_DATE} as timestamp)
    when 4 then cast({_DATE} as timestamp) + interval '8 hours 15 minutes 30 seconds'
  end as hire_date
from orders""",
        "q_salary_usd": (
            f"with raw as ({fixtures.MESSY_SALARIES}) select row_id, "
            f"cast({_bare('base_salary')} as double) as salary_amount, "
            f"{_usd('base_salary')} as salary_usd_annual from raw"
        ),
        "q_clean_records": _final(
            "cleaned_hris", f"select {_C} from cleaned_hris where source_system = 'globaltech_hris'"
        ),
        "q_department_map": _final(
            "cleaned_hris",
            "select source_system, source_employee_id, department, department_standardized "
            "from cleaned_hris",
        ),
        "q_unmapped_departments": _final(
            "cleaned_hris",
            "select distinct source_system, trim(department) as department from cleaned_hris "
            "where department is not null and department_standardized is null",
        ),
        "q_rejected_values": _final(
            "aligned_hris fx_pay fx_ben",
            'select source_system, "column", reason, trim(raw) as raw_value, count(*) as n from ('
            "select source_system, 'employment_type' as \"column\", 'unknown' as reason, employment_type as raw "
            f"from aligned_hris where ({_TYPE_CASE}) is null "
            f"union all select source_system, 'employee_id', 'no digits', employee_id from aligned_hris where {_NO_DIGIT.format('employee_id')} "
            f"union all select source_system, 'manager_id', 'no digits', manager_id from aligned_hris where {_NO_DIGIT.format('manager_id')} "
            f"union all select 'payroll', 'employee_id', 'no digits', employee_id from fx_pay where {_NO_DIGIT.format('employee_id')} "
            f"union all select 'benefits', 'employee_id', 'no digits', employee_id from fx_ben where {_NO_DIGIT.format('employee_id')} "
            f"union all select source_system, 'hire_date', {_BAD_DATE.format('hire_date')}, hire_date from aligned_hris "
            f"union all select 'payroll', 'compensation_effective_date', {_BAD_DATE.format('effective_date')}, effective_date from fx_pay "
            f"union all select 'benefits', 'benefits_enrollment_date', {_BAD_DATE.format('enrollment_date')}, enrollment_date from fx_ben "
            f"union all select 'payroll', 'salary_original', 'unparsed', base_salary from fx_pay where ({_bare('base_salary')}) is null "
            "union all select 'payroll', 'currency', 'unknown', currency from fx_pay where upper(trim(currency)) not in ('USD', 'EUR', 'GBP') "
            "union all select 'payroll', 'pay_frequency', 'unknown', pay_frequency from fx_pay "
            "where lower(trim(pay_frequency)) not in ('annual', 'monthly', 'bi-weekly', 'biweekly', 'bi weekly')"
            ") where reason is not null and trim(raw) <> '' group by all",
        ),
        "q_union_sources": _final("combined", f"select {_C} from combined"),
        "q_hris_survivor": _final("survivors", "select * from survivors"),
        "q_hris_duplicate_review": _final(
            "ranked survivors",
            f"select {', '.join('r.' + c for c in _IDENTITY)}, "
            "'hris_employee_id' as duplicate_check, "
            "(r.source_system is not distinct from s.source_system "
            "and r.email is not distinct from s.email "
            "and r.hire_date is not distinct from s.hire_date) as kept_in_golden, r.rn = 1 as is_survivor "
            "from ranked r join survivors s on r.employee_id is not distinct from s.employee_id "
            "where r.copies > 1",
        ),
        "q_repeated_ids": _final(
            "cleaned_hris", "select employee_id, count(*) as occurrences from cleaned_hris group by 1 having count(*) > 1"
        ),
        "q_payroll_latest": _final("pay_latest", "select * from pay_latest"),
        "q_benefits_summary": _final("ben_summary", "select * from ben_summary"),
        "q_source_systems": _final("provenance", "select * from provenance"),
        "q_golden": _final("golden", "select * from golden"),
        "q_golden_export": _final(
            "golden",
            f"select * replace (cast({_bare('salary_original')} as double) as salary_original) "
            "from golden",
        ),
        "q_ghosts": _final("ghosts", "select * from ghosts"),
        "q_matched_enrichment": _final(
            "cleaned_pay cleaned_ben survivors",
            f"select {_C} from cleaned_pay where not ({_GHOST}) union all "
            f"select {_C} from cleaned_ben where not ({_GHOST})",
        ),
        "q_duplicate_ids": _final(
            "golden",
            "select *, 'employee_id' as duplicate_check from golden "
            "qualify count(*) over (partition by employee_id) > 1",
        ),
        "q_duplicate_ids_in_feeds": _final(
            "ranked",
            f"select {_I}, 'employee_id' as duplicate_check from ranked where copies > 1",
        ),
        "q_duplicate_emails": _final(
            "golden",
            "select *, 'cross_company_email' as duplicate_check from golden where email in "
            "(select email from golden group by email having count(distinct company_origin) > 1)",
        ),
        "q_same_name_matches": _final("same_name", "select * from same_name"),
        "q_fuzzy_matches": _final("fuzzy", "select * from fuzzy"),
        "q_probable_matches": _final("probable", "select * exclude (p) from probable"),
        "q_match_export": _final(
            "probable",
            "select left_employee_id as record_1_id, right_employee_id as record_2_id, "
            "coalesce(name_similarity_score, 100.0) as similarity_score, "
            "hire_date_gap_days as hire_date_diff_days, 'HR_REVIEW' as recommended_action, "
            "match_type, left_company_origin, right_company_origin, left_full_name, "
            "right_full_name, left_email, right_email, left_hire_date, right_hire_date "
            "from probable",
        ),
        "q_token_sort_scores": (
            f"with pairs as (select l.p_partkey, {_tokens('l.p_name')} as a, "
            f"{_tokens('r.p_name')} as b from part l join part r on r.p_partkey = l.p_partkey + 1), "
            f"m as (select *, cast({_lcs('a', 'b')} as integer) as lcs, length(a) + length(b) as n "
            f"from pairs) select p_partkey, a, b, lcs, {_SCORED} as score from m"
        ),
        "q_token_sort_long_texts": (
            f"with described as (select p_partkey, {fixtures.LONG_TEXT} as words from part), pairs as (select l.p_partkey, {_tokens('l.words')} as a, "
            f"{_tokens('r.words')} as b from described l join described r on r.p_partkey = l.p_partkey + 1), "
            f"m as (select *, cast({_lcs('a', 'b')} as integer) as lcs, length(a) + length(b) as n "
            f"from pairs) select p_partkey, length(a) as length_a, length(b) as length_b, lcs, {_SCORED} as score from m"
        ),
        "q_validation_report": _final("golden flags report", "select * from report"),
        "q_salary_failures": _final(
            "golden", _failed("salary_usd_annual_range", "*", "golden")
        ),
        "q_manager_failures": _final(
            "golden", _failed("manager_id_referential_integrity", "*", "golden")
        ),
        "q_unique_failures": _final(
            "ranked", _failed("employee_id_unique", _I, "ranked")
        ),
        "q_headcount_department": _final(
            "golden",
            "select coalesce(department_standardized, 'Unknown') as department_standardized, "
            "count(*) as employee_count from golden group by 1",
        ),
        "q_headcount_country_top15": _final(
            "golden",
            "select coalesce(country, 'Unknown') as country, count(*) as employee_count "
            "from golden group by 1 order by 2 desc, 1 limit 15",
        ),
        "q_salary_box": _final(
            "salary_cents quartiles",
            "select employment_type, max(employee_count) as employee_count, "
            "max(q1) / 400 as q1, max(q2) / 400 as median, max(q3) / 400 as q3, "
            f"least(min(case when {_INSIDE} then c * 4 end), max(q1)) / 400 as whisker_low, "
            f"greatest(max(case when {_INSIDE} then c * 4 end), max(q3)) / 400 as whisker_high, "
            f"count(*) filter (not ({_INSIDE})) as outlier_count "
            "from salary_cents join quartiles using (employment_type) group by employment_type",
        ),
        "q_tenure_histogram": _final(
            "tenures tenure_range",
            "select cast(b as integer) as bin, "
            "round(lo / 365.25::double + (hi / 365.25::double - lo / 365.25::double) / 30 * b, 6) "
            "as from_years, "
            "round(lo / 365.25::double + (hi / 365.25::double - lo / 365.25::double) / 30 * (b + 1), 6) "
            "as to_years, "
            "(select count(*) from tenures where least((d - lo) * 30 // (hi - lo), 29) = b) "
            "as employee_count from tenure_range, range(30) t(b)",
        ),
        "q_benefits_rate": _final(
            "golden",
            "select department_standardized, avg(cast(benefits_enrolled as integer)) as "
            "enrollment_rate from golden where department_standardized is not null group by 1",
        ),
        "q_dq_series": _final(
            "golden flags report",
            "select \"check\", 'passed' as series, passed as row_count from report union all "
            "select \"check\", 'failed', failed from report",
        ),
        "q_source_csv": _final(
            "fx_a", f"select {', '.join(_A)}, 'globaltech_hris' as source_system from fx_a"
        ),
        "q_source_json": _final("fx_b", _PEOPLE),
        "q_source_json_documents": _final("fx_b", _PEOPLE),
        "q_source_json_shapes": f"""
with shaped as (select s_suppkey % 8 as k, cast(s_suppkey as varchar) as id, s_name from supplier), found as (
    select id, case k when 0 then s_name when 2 then '["f"]' end as first, case k when 0 then '7' end as last, null as full_name,
           case k when 1 then 'e@x' end as email, case k when 0 then 'd' end as department, case k when 0 then '{{"a":1}}' end as role
    from shaped where k in (0, 1, 2, 3)
    union all select null, null, null, case k when 7 then s_name end, null, null, null from shaped where k in (3, 7)
)
select id as employee_identifier, first as name_first, last as name_last, full_name as name_full, email as contact_email,
       department as assignment_department, role as assignment_role, cast(null as varchar) as assignment_location,
       cast(null as varchar) as assignment_hire_timestamp, cast(null as varchar) as employment_type,
       cast(null as varchar) as employment_status, cast(null as varchar) as manager_employee_id,
       'acquiredco_hris' as source_system from found""",
        "q_source_csv_ragged": """
with people as (select c_custkey % 6 as k, cast(c_custkey as varchar) as id, c_mktsegment as seg from customer),
pay as (select c_custkey % 4 as k, cast(c_custkey as varchar) as id from customer)
select 'globaltech_hris' as source_system, id as employee_id,
       case k when 3 then 'A, "' || seg || '"' when 4 then 'A,B' else seg end as first_name,
       case k when 0 then 'Last' when 3 then 'B' end as last_name, cast(null as varchar) as base_salary
from people where k <> 2
union all
select 'payroll', case when k in (0, 3) then id end, null, null, case k when 0 then '1,000' when 1 then id end
from pay where k <> 2""",
        "q_source_rejects": """
with people as (select c_custkey % 6 as k, cast(c_custkey as varchar) as id, c_mktsegment as seg from customer),
pay as (select c_custkey % 4 as k, cast(c_custkey as varchar) as id from customer),
documents_read as (select s_suppkey % 8 as k, cast(s_suppkey as varchar) as id from supplier)
select 'globaltech_hris' as source_system, case k when 1 then 'too few values' when 2 then 'too many values' else 'open quote' end as reason,
       id || case k when 1 then ',' || seg when 2 then ',A,B,' || seg else ',"A,B' end as record, true as has_file
from people where k in (1, 2, 4)
union all
select 'payroll', case k when 1 then 'too few values' else 'too many values' end, case k when 1 then id else '1,000,' || id end, true
from pay where k in (1, 2)
union all
select 'acquiredco_hris', case k when 3 then 'not a record' when 4 then 'unreadable' when 6 then 'unreadable' else 'no records' end,
       case k when 3 then id when 4 then '{"employee_identifier": "' || id || '", "name": ' when 6 then '{"employees": "' || id || '"}' end, true
from documents_read where k between 3 and 7""",
        "q_source_all": _final(
            "fx_a fx_b fx_pay fx_ben",
            "select source_system, count(*) as n, count(distinct employee_id) as ids, max(employee_id) as last_id from ("
            "select 'globaltech_hris' as source_system, employee_id from fx_a "
            "union all select 'acquiredco_hris', employee_identifier from fx_b "
            "union all select 'payroll', employee_id from fx_pay "
            "union all select 'benefits', employee_id from fx_ben) group by 1",
        ),
        "q_source_missing": _final(
            "fx_pay",
            "select 'payroll' as source_system, employee_id, source as company_origin, base_salary as salary_original, "
            "currency, effective_date as compensation_effective_date from fx_pay",
        ),
        "q_source_lookup": _final(
            "cleaned_hris",
            "select source_system, department, department_standardized, count(*) as n from cleaned_hris group by 1, 2, 3",
        ),
        "q_source_xml": _final(
            "fx_ben", "select employee_id, enrollment_date, 'benefits' as source_system from fx_ben"
        ),
        "q_source_payroll": _final(
            "fx_pay",
            "select employee_id, source, base_salary, currency, pay_frequency, effective_date, "
            "'payroll' as source_system from fx_pay",
        ),
        "q_sink_golden": _final(
            "golden",
            f"select * replace (cast({_bare('salary_original')} as double) as salary_original) "
            "from golden",
        ),
        "q_sink_review": _final(
            "ghosts",
            "select employee_id, source_employee_id, company_origin, source_system, "
            "salary_original from ghosts",
        ),
    }
