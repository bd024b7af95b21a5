"""The queries of the operators, and the SQL that checks them where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources.tables import read_table
from . import (
    bit_planes, decontamination, licenses, mixing, near_duplicates, neighbour_votes, private_data, quality_rules, repeats, sharding,
    token_counts, warc_store, whitening,
)


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(read_table(spark, folder, "documents"))


def op2_run_length_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(read_table(spark, folder, "documents"))


def op3_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(read_table(spark, folder, "documents"))


def op4_interleaved_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_report(read_table(spark, folder, "documents"))


def op5_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicate_report(read_table(spark, folder, "documents"), size=2, percent=80)


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_report(read_table(spark, folder, "documents"))


def op7_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return private_data.personal_data(read_table(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination_report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op9_warc_store(spark: SparkSession, folder: str) -> DataFrame:
    archive = scratch_path(spark, "archive")
    warc_store.write_archive(read_table(spark, folder, "pages"), archive)
    return warc_store.archive_report(warc_store.read_archive(spark, archive))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.token_lengths(read_table(spark, folder, "documents")))


def op11_neighbour_votes(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_votes.quality_votes(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op12_bit_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return bit_planes.centroid_clusters(read_table(spark, folder, "embeddings"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(read_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_license_scan, op2_run_length_repeats, op3_source_mix, op4_interleaved_shards, op5_near_duplicates,
        op6_quality_rules, op7_personal_data, op8_decontamination, op9_warc_store, op10_token_counts,
        op11_neighbour_votes, op12_bit_plane_clusters, op13_whitening,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": licenses.LICENSE_SQL,
    "op3_source_mix": mixing.MIX_SQL,
    "op6_quality_rules": quality_rules.QUALITY_SQL,
    "op9_warc_store": warc_store.ARCHIVE_SQL,
    "op12_bit_plane_clusters": bit_planes.CLUSTER_SQL,
}
