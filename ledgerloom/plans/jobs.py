"""The whole way from landed files to what is asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.operators import forms, longrows, marts, search
from ledgerloom.plans.common import checkpointed
from ledgerloom.sources import sinks, versions, warehouse
from ledgerloom.sources.files import read_grids, read_xml_forms


def view_marts(v: DataFrame, status: DataFrame) -> dict[str, DataFrame]:
    """The marts of a fact view that need no names of cells."""
    return {
        "kpi": marts.kpi(v, status), "coverage_grid": marts.coverage_grid(v), "timeline": marts.counts(v.filter("year is not null"), "year", "scope"), "volume": marts.volume(v),
        "unit_profile": marts.counts(v, "unit_source"), "period_kinds": marts.counts(v, "kind"), "top_indicators": marts.top(v.filter("char_length(indicator) > 6"), "indicator", 25),
        "method_mix": marts.counts(status, "province", "method"), "pending_by_method": marts.counts(status.filter("rows = 0"), "method"), "top_formats": marts.top(status, "exts", 14),
    }


def build_warehouse(spark: SparkSession, landed: str, files: DataFrame, reports: DataFrame, path: str) -> int:
    """Parses all landed files and writes, under path, the long table with its summary and pending reports, the star, the label index and the marts.

    files (path, report_id, url) and reports (with province and files) are the catalog. The version of the star is returned.
    Each step reads what the one before has stored; running it again replaces what it wrote.
    """
    tags, cells = checkpointed(read_xml_forms(spark, landed)), checkpointed(read_grids(spark, landed))
    rows = checkpointed(longrows.parsed_rows(tags, cells, files, reports))
    marked = checkpointed(longrows.long_table(rows))
    kept = marked.filter("dup_kind = ''").drop("dup_kind")
    status = checkpointed(forms.report_status(reports, longrows.parsed_counts(tags, cells, kept, files)))
    sinks.write_corpus(marked, status, path)
    version = warehouse.load(spark, f"{path}/star", kept, status)
    dims = {n: versions.read(spark, f"{path}/star", n) for n in warehouse.DIMENSIONS}
    search.store_index(search.star_stats(versions.read(spark, f"{path}/star", "fact_row"), dims), f"{path}/labels")
    sinks.write_marts(view_marts(warehouse.view(spark, f"{path}/star"), status), f"{path}/marts", "parquet")
    return version
