"""Raw feeds derived from the given tables.

No given table holds appointments or slots, so both are derived, whole, from
``orders`` with ``customer`` and from ``lineitem``. The text is valid in Spark
and in DuckDB and holds every kind of defect the checks look for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Parameters of all registered queries.
AS_OF = "2021-12-17"
FIRST_DAY = "2021-01-18"
WEEKS = 5
THRESHOLD = 0.001

RAW_BOOKINGS_SQL = """
select o_orderkey as rdv_id,
 case when o_orderkey % 3 = 0 then 'maiia' when o_orderkey % 3 = 1 then 'keldoc' else 'doctolib' end as operateur,
 case when o_orderkey % 17 = 0 then null when o_orderkey % 223 = 0 then '31-31-31'
      when o_orderkey % 3 = 1 then substr(c,9,2)||'/'||substr(c,6,2)||'/'||substr(c,3,2) else c end as date_creation,
 case when o_orderkey % 211 = 0 then 'bad-date'
      when o_orderkey % 3 = 1 then substr(d,9,2)||'/'||substr(d,6,2)||'/'||substr(d,3,2) else d end as date_rdv,
 case when o_custkey % 50 = 49 then null else 'C' || cast(o_custkey % 50 as string) end as id_centre,
 case when o_custkey % 71 = 0 then null else c_mktsegment end as nom_centre,
 case when o_custkey % 83 = 0 then null when o_custkey % 89 = 0 then '1234567'
      when o_custkey % 97 = 0 and o_orderkey % 3 = 2 then '20100 Cedex'
      when o_custkey % 10 = 1 then cast(20000 + (o_custkey * 7) % 1000 as string)
      when o_custkey % 10 = 2 then cast(97100 + (o_custkey % 7) * 100 as string)
      else cast(1000 + (o_custkey * 617) % 95000 as string) end as cp_centre,
 case when o_orderkey % 13 = 0 then null when o_orderkey % 13 = 1 then '1ere injection CNAM'
      when o_orderkey % 13 = 2 then 'Rappel Moderna' when o_orderkey % 13 = 3 then 'Pfizer PÉDIATRIE'
      when o_orderkey % 13 = 4 then 'astrazeneca puis Janssen' when o_orderkey % 13 = 5 then 'patient immunodeprime'
      when o_orderkey % 13 = 6 then 'pedia pfizer cnam' else o_orderpriority end as motif_rdv,
 case when o_orderkey % 11 = 0 then 'R' when o_orderkey % 11 = 1 then null when o_orderkey % 11 = 2 then 'dose 3'
      when o_orderkey % 11 = 3 then '14' when o_orderkey % 11 = 4 then '9'
      else cast(1 + o_orderkey % 2 as string) end as rang_vaccinal,
 case when o_orderkey % 2 = 0 then null else 'SPECIFIQUE' end as parcours_rdv,
 case when o_orderkey % 19 = 0 then null else cast(1930 + o_custkey % 80 as string) end as annee_naissance,
 case when o_orderkey % 307 = 0 then 'oui' when o_orderstatus = 'F' then 't' when o_orderstatus = 'P' then 'VRAI'
      when o_orderkey % 5 = 0 then 'FAUX' else null end as honore,
 case when o_orderkey % 311 = 0 then '?' when o_orderkey % 7 = 0 then 'T' when o_orderkey % 7 = 1 then null
      else 'false' end as annule,
 case when o_orderkey % 4 = 0 then null when o_orderkey % 4 = 1 then 'Pfizer' else 'Moderna' end as type_vaccin
from (select o.*, c_mktsegment,
        cast(cast('2020-12-01' as date) + cast((o_orderkey * 13) % 730 as int) as string) as d,
        cast(cast('2020-11-15' as date) + cast((o_orderkey * 13) % 730 as int) as string) as c
      from orders o join customer on c_custkey = o_custkey) q
"""

RAW_SLOTS_SQL = """
select l_orderkey, l_linenumber,
 case when l_orderkey % 3 = 0 then 'maiia' when l_orderkey % 3 = 1 then 'keldoc' else 'doctolib' end as operateur,
 case when l_orderkey % 101 = 0 then 'semaine ' || cast(l_linenumber as string)
      when l_orderkey % 3 = 1 and l_orderkey % 5 = 0 then substr(d,9,2)||'/'||substr(d,6,2)||'/'||substr(d,1,4)||' 08:30:00'
      when l_orderkey % 3 = 1 then substr(d,9,2)||'/'||substr(d,6,2)||'/'||substr(d,1,4)
      when l_orderkey % 5 = 0 then d || ' 08:30:00' else d end as date_brute,
 'C' || cast(l_suppkey as string) as id_centre,
 'Centre ' || cast(l_suppkey as string) as nom_centre,
 case when l_suppkey % 23 = 0 then null
      when l_suppkey % 10 = 3 and l_orderkey % 3 = 2 then ' ' || cast(1000 + l_suppkey as string)
      when l_suppkey % 10 = 1 then cast(20000 + (l_suppkey * 37) % 1000 as string)
      when l_suppkey % 10 = 2 then cast(97100 + (l_suppkey % 7) * 100 as string)
      else cast(1000 + (l_suppkey * 617) % 95000 as string) end as cp_centre,
 case when l_orderkey % 3 = 1 and l_linenumber = 1 then ' -   ' else cast(1 + cast(l_quantity as int) % 9 as string) end as nb_heures,
 case when l_orderkey % 3 = 1 and l_linenumber = 2 then ' -   ' else cast(l_linenumber as string) end as nb_lignes,
 case when l_orderkey % 3 = 0 then null when l_orderkey % 3 = 1 and l_linenumber = 3 then ' -   '
      else cast(cast(l_quantity as int) as string) end as nb_creneaux,
 case when l_orderkey % 3 = 0 then null when l_returnflag = 'R' then 'Pfizer' when l_returnflag = 'A' then 'Moderna'
      else null end as type_vaccin
from (select l.*, cast(cast('2021-01-04' as date) + cast((l_orderkey * 13) % 365 as int) as string) as d from lineitem l) q
"""


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as raw appointments, with ``rdv_id``."""
    text = RAW_BOOKINGS_SQL.replace("from orders o join customer", "from {orders} o join {customer}")
    return spark.sql(
        text, orders=given(spark, sf_dir, "orders"), customer=given(spark, sf_dir, "customer")
    )


def raw_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items as raw slots, with ``l_orderkey`` and ``l_linenumber``.

    maiia delivers neither slot counts nor vaccine types, which its reader
    fills; the derived feed is given the same fill.
    """
    text = RAW_SLOTS_SQL.replace("from lineitem l", "from {lineitem} l")
    rows = spark.sql(text, lineitem=given(spark, sf_dir, "lineitem"))
    maiia = F.col("operateur") == "maiia"
    return rows.withColumnRenamed("date_brute", "date").withColumns(
        {
            name: F.when(maiia, F.lit("NR")).otherwise(F.col(name))
            for name in ("nb_creneaux", "type_vaccin")
        }
    )
