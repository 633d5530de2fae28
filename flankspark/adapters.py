"""Domain tables derived from the driver's tables.

An adapter is a list of expressions that Spark and DuckDB read alike, so a query and its SQL start from the same rows, and both grow with
the given tables. Operators never see these names: they take the schemas of the domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flankspark.tables import table

HEX, BASES = "'0123456789abcdef'", "'ACGTACGTACGTACGT'"


def bases(key: str) -> str:
    """32 bases that follow from a key."""
    return f"translate(md5(cast({key} as string)), {HEX}, {BASES})"


#: A sequence of 20 to 32 bases with few different values, one base replaced.
SEQ = f"substring(concat(substring({bases('l_partkey % 25')}, 1, cast(l_quantity as int) % 24), 'T', substring({bases('l_partkey % 25')}, cast(l_quantity as int) % 24 + 2, 40)), 1, cast(20 + l_linenumber % 5 * 3 as int))"

ADAPTERS: dict[str, tuple[str, list[str], str]] = {
    "alignments": (
        "lineitem",
        [
            "concat('S', cast(l_suppkey % 20 as string)) as sample",
            "concat('r', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as query_name",
            "concat('E', cast(l_partkey % 40 as string)) as reference",
            "cast(case when l_partkey % 40 = 39 then null else 600 + 10 * (l_partkey % 40) end as int) as ref_length",
            "cast(case when l_linenumber % 3 = 0 then l_orderkey % 40 when l_linenumber % 3 = 1 then 560 + 10 * (l_partkey % 40) - l_orderkey % 60 else l_orderkey % 500 end as int) as ref_start",
            "cast(case when l_linenumber % 3 = 1 then 600 + 10 * (l_partkey % 40) - l_orderkey % 30 else (case when l_linenumber % 3 = 0 then l_orderkey % 40 else l_orderkey % 500 end) + 15 + l_suppkey % 70 end as int) as ref_end",
            "cast(l_quantity as int) as mapq",
            "cast(case when l_partkey % 11 = 0 then 256 when l_suppkey % 2 = 0 then 16 else 0 end as int) as flag",
            "cast(case when l_linenumber = 7 then null else floor(l_discount * 100) end as int) as nm",
            "cast(case when l_linenumber % 3 = 0 or l_orderkey % 13 = 0 then floor(l_tax * 100) * 4 else 0 end as int) as left_clip",
            "cast(case when l_linenumber % 3 <> 0 or l_orderkey % 17 = 0 then floor(l_tax * 100) * 4 else 0 end as int) as right_clip",
            f"concat(case when l_orderkey % 97 = 0 then 'N' else 'A' end, {bases('l_orderkey')}, {bases('l_partkey')}) as query_sequence",
        ],
        "true",
    ),
    "overhangs": (
        "lineitem",
        [
            "concat('S', cast(l_suppkey as string)) as sample",
            "concat('r', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as read_id",
            "concat('E', cast(l_partkey % 10 as string)) as is_element",
            "case when l_returnflag = 'N' then 'left' else 'right' end as side",
            "case when l_linestatus = 'F' and l_linenumber = 1 then 'ambiguous' when l_returnflag = 'N' then 'left' else 'right' end as bucket",
            "cast(l_quantity as int) as mapq",
            f"{SEQ} as seq",
        ],
        "true",
    ),
    "hsps": (
        "lineitem",
        [
            "concat('S', cast(l_suppkey % 5 as string), '__E', cast(l_partkey % 12 as string), '__', case when l_linenumber % 2 = 0 then 'left' else 'right' end, '__cluster', cast(l_orderkey % 60 as string)) as qseqid",
            "concat('G', cast(l_suppkey % 6 as string), '__c', cast(l_partkey % 3 as string)) as sseqid",
            "cast(90 as double) + floor(l_discount * 100) as pident",
            "cast(30 + l_orderkey % 21 as int) as length",
            "cast(1 + l_linenumber % 3 % 2 as int) as qstart",
            "cast(case when l_orderkey % 5 = 0 then 49 else 50 end as int) as qend",
            "cast(50 as int) as qlen",
            "cast(1 + l_orderkey * 37 % 20000 as int) as sstart",
            "cast(1 + l_orderkey * 37 % 20000 + case when l_suppkey % 2 = 0 then 49 else -49 end as int) as send",
            "case when l_suppkey % 2 = 0 then 'plus' else 'minus' end as sstrand",
            "cast(l_quantity as double) * 2 as bitscore",
            "l_tax / 1000 as evalue",
        ],
        "true",
    ),
    "clusters": (
        "lineitem",
        [
            "concat('S', cast(l_suppkey % 5 as string)) as sample",
            "concat('E', cast(l_partkey % 12 as string)) as is_element",
            "case when l_linenumber % 2 = 0 then 'left' else 'right' end as side",
            "cast(l_orderkey % 60 as int) as cluster_id",
            f"concat({bases('l_orderkey % 60')}, {bases('l_partkey % 12')}) as rep_seq",
        ],
        "true",
    ),
    "cds": (
        "part",
        [
            "concat('G', cast(p_size % 6 as string)) as ref_genome",
            "concat('c', cast(p_partkey % 3 as string)) as contig",
            "cast(p_partkey * 37 % 20000 as int) as start",
            "cast(p_partkey * 37 % 20000 + 60 + cast(floor(p_retailprice) as bigint) % 900 as int) as end_",
            "case when p_partkey % 2 = 0 then '+' else '-' end as strand",
            "concat('g', cast(p_partkey as string)) as gene",
        ],
        "true",
    ),
    "placements": (
        "orders",
        [
            "concat('S', cast(cast(floor(o_custkey / 50) as int) as string)) as sample",
            "concat('E', cast(o_orderkey % 7 as string)) as is_element",
            "case when o_orderstatus = 'F' then 'left' else 'right' end as side",
            "cast(o_orderkey % 40 as int) as cluster_id",
            "concat('G', cast(o_custkey % 3 as string)) as ref_genome",
            "'c0' as contig",
            "case when o_orderpriority < '3' then '+' else '-' end as strand",
            "cast(o_orderkey * 53 % 900 as int) as junction_pos",
            "cast(floor(o_totalprice) as double) as score",
        ],
        "true",
    ),
    "sites": ("events", ["cast(user_id as string) as grp", "event_type as kind", "cast(event_id * 17 % 5000 as int) as pos"], "true"),
    "intervals": ("orders", ["concat('c', cast(o_custkey % 50 as string)) as chrom", "cast(o_orderkey * 31 % 50000 as int) as start", "cast(o_orderkey * 31 % 50000 + cast(floor(o_totalprice) as bigint) % 400 as int) as end_"], "true"),
    "features": ("part", ["concat('c', cast(p_partkey % 50 as string)) as chrom", "cast(p_partkey as int) as feature_id", "cast(p_partkey * 41 % 50000 as int) as start", "cast(p_partkey * 41 % 50000 + 1 + p_size * 20 as int) as end_"], "true"),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, where = ADAPTERS[name]
    return table(spark, sf_dir, source).where(where).selectExpr(*columns)


def sql(name: str) -> str:
    """The adapter as a common table expression of DuckDB."""
    source, columns, where = ADAPTERS[name]
    return f"{name} AS (SELECT {', '.join(columns)} FROM {source} WHERE {where})"
