"""Feeds of the right shape derived from the TPC-H-like test tables.

The same SQL text runs in Spark and in DuckDB. Every customer, supplier and order is in a
feed; ghosts, and people whose manager does not exist, are rows added with ids of their own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rollbook.config import IDENTITY_SOURCES, Settings
from rollbook.operators import identity
from rollbook.plans import build

AS_OF = dt.date(2024, 12, 31)
SETTINGS = Settings(as_of=AS_OF)

HRIS_A = """
select case when c_custkey % 3 = 0 then cast(c_custkey as string) || '.0' else cast(c_custkey as string) end as employee_id,
       upper(split_part(p_name, ' ', 1)) as first_name,
       '  ' || split_part(p_name, ' ', 2) || ' ' || cast(c_custkey % 10 as string) as last_name,
       upper(split_part(p_name, ' ', 2)) || '.' || cast(c_custkey % 10 as string) || '@Example.com ' as email,
       c_mktsegment as department, p_type as job_title,
       cast(date '1995-01-01' + cast((c_custkey * 37) % 2000 as int) as string) as hire_date,
       n_name as country,
       case c_custkey % 5 when 0 then 'FT' when 1 then 'part time' when 2 then 'Contract' when 3 then ' Full-Time ' else 'intern' end as employment_type,
       cast(cast(floor(c_custkey / 10) as bigint) as string) || '.0' as manager_id,
       0 as row_ord
from customer join part on p_partkey = c_custkey join nation on n_nationkey = c_nationkey
union all
select cast(c_custkey as string), split_part(p_name, ' ', 1),
       split_part(p_name, ' ', 2) || ' ' || cast(c_custkey % 10 as string), cast(null as string),
       cast(null as string), p_type,
       cast(date '1995-01-01' + cast((c_custkey * 37) % 2000 as int) as string),
       cast(null as string), 'FT', cast(null as string), 1
from supplier join customer on c_custkey = s_suppkey * 14 + 5 join part on p_partkey = c_custkey
union all
select cast(s_suppkey + 8000000000 as string), upper(split_part(p_name, ' ', 1)),
       split_part(p_name, ' ', 2) || ' ' || cast(s_suppkey % 10 as string), cast(null as string),
       'HOUSEHOLD', p_type,
       cast(date '1995-01-01' + cast((s_suppkey * 37) % 2000 as int) as string),
       n_name, 'FT', cast(s_suppkey + 7000000000 as string), 0
from supplier join part on p_partkey = s_suppkey * 7 + 3 join nation on n_nationkey = s_nationkey
"""

HRIS_B = """
select 'ACQ_' || lpad(cast(s_suppkey as string), 5, '0') as employee_identifier,
       split_part(p_name, ' ', 1) as first_name,
       split_part(p_name, ' ', 2) || ' ' || cast(s_suppkey % 10 as string) as last_name,
       split_part(p_name, ' ', 2) || '.' || cast(s_suppkey % 10 as string) || '@example.com' as email,
       case s_suppkey % 4 when 0 then 'it' when 1 then 'Human Resources ' when 2 then 'BUILDING' else 'Skunkworks' end as department,
       p_type as role, n_name as location,
       cast(date '1995-01-01' + cast((s_suppkey * 53) % 2000 as int) as string) || 'T00:00:00Z' as hire_timestamp,
       'Full Time' as type,
       case when s_suppkey % 2 = 0 then 'ACQ_00000' else null end as manager_employee_id
from supplier join part on p_partkey = s_suppkey * 7 + 3 join nation on n_nationkey = s_nationkey
"""

PAYROLL = """
select cast(o_custkey as string) as employee_id, 'GlobalTech' as source,
       '$' || cast(cast(o_totalprice as decimal(18,2)) as string) as base_salary,
       case o_orderpriority when '1-URGENT' then 'USD' when '2-HIGH' then 'EUR' when '3-MEDIUM' then 'GBP' when '4-NOT SPECIFIED' then ' usd ' else 'JPY' end as currency,
       case o_orderstatus when 'F' then 'Annual' when 'O' then 'Monthly' else 'Bi-Weekly' end as pay_frequency,
       case when o_orderkey % 11 = 0 then null else cast(cast(o_orderdate as date) as string) end as effective_date,
       o_orderkey as row_ord
from orders
union all
select 'ACQ_' || lpad(cast(s_suppkey as string), 5, '0'), 'AcquiredCo',
       cast(cast(s_acctbal as decimal(18,2)) * 10 as string), 'USD', 'annual', '2001-01-01', -1 - s_suppkey
from supplier
union all
select cast(s_suppkey + 9000000000 as string), 'GlobalTech',
       cast(cast(s_acctbal as decimal(18,2)) * 10 as string), 'USD', 'annual', '2001-01-01', -9000000000 - s_suppkey
from supplier
union all
select 'ACQ_' || cast(s_suppkey + 9000000000 as string), 'AcquiredCo',
       cast(cast(s_acctbal as decimal(18,2)) * 10 as string), 'USD', 'annual', '2001-01-01', -18000000000 - s_suppkey
from supplier
"""

BENEFITS = """
select cast(user_id as string) as employee_id, cast(cast(ts as date) as string) as enrollment_date, event_id as row_ord
from events where event_type = 'signup'
union all
select cast(s_suppkey + 9000000000 as string), '2001-01-01', -1 - s_suppkey
from supplier
"""

DEPARTMENT_MAPPING = """
select * from (values
  ('globaltech_hris','MACHINERY','Manufacturing'), ('globaltech_hris','AUTOMOBILE','Manufacturing'),
  ('globaltech_hris','BUILDING','Operations'), ('globaltech_hris','FURNITURE','Operations'),
  ('acquiredco_hris','IT','Information Technology'), ('acquiredco_hris','Human Resources','Human Resources'),
  ('acquiredco_hris','Building','Operations')) t(source_system, source_department, standard_department)
"""

# A part's columns as one text of more than a hundred characters.
LONG_TEXT = "lower(p_name) || ' ' || lower(p_type) || ' ' || lower(p_brand) || ' size ' || cast(p_size as string) || ' made for ' || lower(p_type) || ' of ' || lower(p_name) || ' and others'"

_TABLES = ("customer", "part", "nation", "supplier", "orders", "events")


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Its footer is read once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _derive(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    used = [t for t in _TABLES if f" {t} " in f"{sql} ".replace("\n", " ")]
    ctes = ", ".join(f"{t} AS (SELECT * FROM {{{t}}})" for t in used)
    tables = {t: table(spark, sf_dir, t) for t in used}
    sql = sql.replace("{", "{{").replace("}", "}}")  # only the tables are to be filled in
    return spark.sql(f"WITH {ctes} {sql}" if used else sql, **tables)


def _person_documents(rows: DataFrame) -> DataFrame:
    return rows.selectExpr(
        "employee_identifier",
        "struct(first_name AS first, last_name AS last, "
        "concat_ws(' ', first_name, last_name) AS full) AS name",
        "struct(email) AS contact",
        "struct(department, role, location, hire_timestamp) AS assignment",
        "struct(type, 'active' AS status) AS employment",
        "manager_employee_id",
    )


FEEDS = {
    "globaltech_hris": HRIS_A,
    "acquiredco_hris": HRIS_B,
    "payroll": PAYROLL,
    "benefits": BENEFITS,
}


def raw_sources(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The raw feeds (all four unless named), each in the shape its reader returns."""
    feeds = {name: _derive(spark, sf_dir, FEEDS[name]) for name in names or FEEDS}
    if "acquiredco_hris" in feeds:
        feeds["acquiredco_hris"] = _person_documents(feeds["acquiredco_hris"])
    return feeds


def department_mapping(spark: SparkSession) -> DataFrame:
    return spark.sql(DEPARTMENT_MAPPING)


def combined(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    raw = raw_sources(spark, sf_dir, *names)
    return build.combine(raw, department_mapping(spark), SETTINGS)


def identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identity.identity_records(combined(spark, sf_dir, *IDENTITY_SOURCES))


# --- untidy single columns, each value made from a known one ----------------------

MESSY_IDS = """
select c_custkey as row_id,
       case c_custkey % 4 when 0 then 'GlobalTech' when 1 then ' AcquiredCo ' when 2 then 'GlobalTech' else 'Other Ltd' end as company,
       case c_custkey % 8 when 0 then cast(c_custkey as string) || '.0' when 1 then 'ACQ_' || cast(c_custkey + 1000000 as string)
            when 2 then ' 00' || cast(c_custkey as string) || ' ' when 4 then '.' || cast(c_custkey as string)
            when 5 then 'none' when 6 then cast(c_custkey + 990000 as string) || '.75' else 'ACQ_' || cast(c_custkey as string) || '-2' end as raw_id,
       case when c_custkey % 10 < 2 then null else cast(c_nationkey as string) || '.0' end as raw_manager
from customer
"""

MESSY_NAMES = """
select c_custkey as row_id,
       case c_custkey % 4 when 0 then '  ' || upper(p_type) || '-' || lower(p_type) when 1 then lower(p_type) || '''' || upper(p_type) || '  '
            when 2 then '   ' else 'élo' || lower(p_type) || ' 3rd' end as first,
       case c_custkey % 3 when 0 then null when 1 then upper(c_mktsegment) else 'x_' || lower(c_mktsegment) end as last,
       case when c_custkey % 7 = 0 then null else '  ' || c_name || '@Example.COM ' end as email
from customer join part on p_partkey = c_custkey
"""

_ISO = "cast(cast(o_orderdate as date) as string)"
MESSY_DATES = f"""
select o_orderkey as row_id,
       case o_orderkey % 7 when 0 then ' FT ' when 1 then 'Full Time' when 2 then 'PT' when 3 then 'part-time'
            when 4 then 'CONTRACT' when 5 then 'intern' else null end as raw_type,
       case o_orderkey % 9 when 0 then {_ISO} when 1 then {_ISO} || 'T23:30:00-05:00'
            when 2 then substr({_ISO}, 6, 2) || '/' || substr({_ISO}, 9, 2) || '/' || substr({_ISO}, 1, 4)
            when 3 then replace({_ISO}, '-', '') when 4 then ' ' || {_ISO} || ' 08:15:30 ' when 5 then '1969-12-31'
            when 6 then '2999-01-01' when 7 then 'soon' else null end as raw_date
from orders
"""

MESSY_SALARIES = """
select o_orderkey as row_id,
       case o_orderkey % 5 when 0 then '$' || cast(cast(o_totalprice as decimal(18,2)) as string)
            when 1 then ' €' || cast(cast(o_totalprice as decimal(18,2)) as string) || ' '
            when 2 then '1,' || cast(100000 + o_orderkey % 800000 as string) || '.125' when 3 then 'tbd' else '' end as base_salary,
       case o_orderkey % 6 when 0 then 'USD' when 1 then 'eur' when 2 then ' GBP ' when 3 then 'usd' when 4 then 'JPY' else null end as currency,
       case o_orderkey % 7 when 0 then 'Annual' when 1 then ' monthly' when 2 then 'Bi-Weekly' when 3 then 'BIWEEKLY'
            when 4 then 'bi weekly' when 5 then 'weekly' else 'annual' end as pay_frequency
from orders
"""


# --- files with records of every shape, each line made from a known row -----------

_ID = "cast(s_suppkey as string)"
JSON_LINES = f"""
select case s_suppkey % 8
       when 0 then '{{"employee_identifier": "' || {_ID} || '", "name": {{"first": "' || s_name || '", "last": 7}}, "assignment": {{"department": "d", "role": {{"a": 1}}}}, "extra": [1]}}'
       when 1 then '{{"employee_identifier": "' || {_ID} || '", "name": "' || s_name || '", "contact": {{"email": "e@x"}}}}'
       when 2 then '{{"employee_identifier": ' || {_ID} || ', "name": {{"first": ["f"], "full": null}}, "contact": ["e"]}}'
       when 3 then '{{"employees": [{{"employee_identifier": "' || {_ID} || '", "assignment": true}}, {{"name": 5}}, ' || {_ID} || ']}}'
       when 4 then '{{"employee_identifier": "' || {_ID} || '", "name": '
       when 5 then '{{"staff": "' || {_ID} || '"}}'
       when 6 then '{{"employees": "' || {_ID} || '"}}'
       else '[{{"contact": null, "name": {{"full": "' || s_name || '"}}}}, {{"employee_identifier": null}}]' end as value
from supplier
"""

_KEY = "cast(c_custkey as string)"
# for the header employee_id, first_name, last_name
CSV_LINES = f"""
select {_KEY} || case c_custkey % 6
       when 0 then ',' || c_mktsegment || ',Last' when 1 then ',' || c_mktsegment when 2 then ',A,B,' || c_mktsegment
       when 3 then ',"A, ""' || c_mktsegment || '""' || '",B' when 4 then ',"A,B' else ',' || c_mktsegment || ',' end as value
from customer
"""
# for the header base_salary, employee_id
PAYROLL_LINES = f"""
select case c_custkey % 4 when 0 then '"1,000",' || {_KEY} when 1 then {_KEY} when 2 then '1,000,' || {_KEY} else ',' || {_KEY} end as value
from customer
"""

def lines(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One text column, ``value``, from one of the statements above."""
    return _derive(spark, sf_dir, sql)


def messy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MESSY_IDS)


def messy_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MESSY_NAMES)


def messy_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MESSY_DATES)


def messy_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derive(spark, sf_dir, MESSY_SALARIES)
