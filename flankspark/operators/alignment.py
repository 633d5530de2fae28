"""Filtering alignments down to reads that cross an element's edge, and cutting off what overhangs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Unmapped, secondary and supplementary alignments.
SKIPPED_FLAGS = 0x904
REASONS = ("non_acgt", "short_is_alignment", "not_at_boundary", "dual_clip", "no_softclip_on_eligible_side", "short_clip", "no_nm", "low_pident")


@dataclass(frozen=True)
class Limits:
    min_mapq: int = 30
    min_pident: float = 90.0
    min_clip: int = 5
    tolerance: int = 20
    min_aligned: int = 20


def percent_identity(aligned: Column, nm: Column) -> Column:
    """100 (aligned - nm) / aligned; null without nm or aligned bases."""
    return F.when(nm.isNotNull() & (aligned > 0), 100.0 * (aligned - nm) / aligned)


def clip_length(cigar: Column, at: int) -> Column:
    """Length of the soft clip at the first (1) or last (-1) operation; any other operation there hides one."""
    op = F.element_at(cigar, at)
    return F.when(op["op"] == 4, op["len"]).otherwise(0)


def filter_alignments(alignments: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Alignments with drop_reason (the first that applies, null if kept), pident, zl, zr and za.

    Takes sample, query_name, reference, ref_length, ref_start, ref_end, mapq, flag, nm, cigar and query_sequence. Records that are
    unmapped, secondary, supplementary or without cigar or sequence are passed over and not counted, as are those on an unknown reference
    (a null ref_length) unless one of the first two reasons applies. One narrow projection: no shuffle.
    """
    a = alignments.where((F.col("flag").bitwiseAND(SKIPPED_FLAGS) == 0) & F.col("cigar").isNotNull() & F.col("query_sequence").isNotNull())
    aligned = F.col("ref_end") - F.col("ref_start")
    a = a.withColumns({"near_start": F.col("ref_start") <= limits.tolerance, "near_end": F.col("ref_length") - F.col("ref_end") <= limits.tolerance, "left_n": clip_length(F.col("cigar"), 1), "right_n": clip_length(F.col("cigar"), -1), "pident": percent_identity(aligned, F.col("nm"))})
    left, right = F.col("near_start") & (F.col("left_n") > 0), F.col("near_end") & (F.col("right_n") > 0)
    a = a.withColumns({"zl": F.col("near_start") & (F.col("left_n") >= limits.min_clip), "zr": F.col("near_end") & (F.col("right_n") >= limits.min_clip), "za": F.col("mapq") < limits.min_mapq})
    tests = [
        ~F.upper("query_sequence").rlike("^[ACGT]*$"), aligned < limits.min_aligned, ~(F.col("near_start") | F.col("near_end")), (F.col("left_n") > 0) & (F.col("right_n") > 0),
        ~(left | right), ~(F.col("zl") | F.col("zr")), F.col("nm").isNull(), F.col("pident") < limits.min_pident,
    ]
    reason = F.coalesce(*[F.when(t, F.lit(r)) for t, r in zip(tests, REASONS, strict=True)])
    return a.withColumn("drop_reason", reason).where(F.col("ref_length").isNotNull() | F.col("drop_reason").isin(*REASONS[:2]))


def reason_counts(filtered: DataFrame) -> DataFrame:
    return filtered.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("drop_reason")).agg(F.count("*").alias("n"))


def overhangs(filtered: DataFrame) -> DataFrame:
    """A row for each clipped end of a kept read: side, bucket (ambiguous overrides the side), clipped bases and position."""
    kept = filtered.where("drop_reason is null")
    ends = F.array(
        F.when(F.col("zl"), F.struct(F.lit("left").alias("side"), F.substring("query_sequence", F.lit(1), F.col("left_n")).alias("seq"), F.col("ref_start").alias("pos"))),
        F.when(F.col("zr"), F.struct(F.lit("right").alias("side"), F.right("query_sequence", F.col("right_n")).alias("seq"), F.col("ref_end").alias("pos"))),
    )
    out = kept.select("sample", F.col("query_name").alias("read_id"), F.col("reference").alias("is_element"), F.explode(F.filter(ends, lambda x: x.isNotNull())).alias("x"), "za", "pident", "mapq", "flag")
    strand = F.when(F.col("flag").bitwiseAND(16) != 0, F.lit("-")).otherwise(F.lit("+"))
    return out.select("sample", "read_id", "is_element", "x.side", F.when(F.col("za"), F.lit("ambiguous")).otherwise(F.col("x.side")).alias("bucket"), "x.seq", "x.pos", strand.alias("strand"), F.bround("pident", 2).alias("pident"), "mapq")


def manifest(overhang: DataFrame) -> DataFrame:
    return overhang.groupBy("sample", "is_element", "bucket").agg(F.count("*").alias("n_seqs"))


def manifest_with_database(overhang: DataFrame, order: list[str]) -> DataFrame:
    """manifest with the database of each element of a sample: that of its last read in order, also if that is in another bucket."""
    last = overhang.groupBy("sample", "is_element").agg(F.max_by(F.coalesce("database", F.lit("")), F.struct(*order)).alias("database"))
    return manifest(overhang).join(last, ["sample", "is_element"])


def wanted(manifest: DataFrame, elements: list[str] | None = None, sides: tuple[str, ...] = ("left", "right")) -> DataFrame:
    """(sample, is_element, bucket) of the entries of a manifest that aren't empty, are of one of the sides, and of one of the elements if those are given.

    Reads that are held for recruitment (bucket ambiguous) belong to no side, so they are passed over.
    """
    out = manifest.where((F.col("n_seqs") > 0) & F.col("bucket").isin(*sides))
    return (out if elements is None else out.where(F.col("is_element").isin(*elements))).select("sample", "is_element", "bucket")


def scan_by(manifest: DataFrame, overhang: DataFrame, elements: list[str] | None = None) -> DataFrame:
    """The overhangs that wanted entries of the manifest name."""
    return overhang.join(wanted(manifest, elements), ["sample", "is_element", "bucket"], "left_semi")


def side_hits(filtered: DataFrame, min_hits: int = 10) -> DataFrame:
    """Kept reads whose element has at least min_hits unambiguous reads on a side that the read crosses; ambiguous reads stay."""
    by = Window.partitionBy("sample", "reference")
    kept = filtered.where("drop_reason is null").withColumns({"n_left": F.sum(F.when(F.col("zl") & ~F.col("za"), 1).otherwise(0)).over(by), "n_right": F.sum(F.when(F.col("zr") & ~F.col("za"), 1).otherwise(0)).over(by)})
    out = kept.withColumns({"zl": F.col("zl") & (F.col("za") | (F.col("n_left") >= min_hits)), "zr": F.col("zr") & (F.col("za") | (F.col("n_right") >= min_hits))})
    return out.where(F.col("zl") | F.col("zr"))
