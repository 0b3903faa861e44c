"""Raw lines -> structured rows."""

from pyspark.sql import DataFrame, SparkSession

from cinderlog import constants as K
from cinderlog import schema
from cinderlog.operators.parse import accepted, parse_header, rejected
from cinderlog.operators.templates import assign_templates, mine_templates, with_shape
from cinderlog.sources.files import raw_lines
from cinderlog.sources.sinks import write_structured


def structure(lines: DataFrame, masks=K.MASKS, depth=K.MINING_DEPTH,
              similarity=K.MINING_SIMILARITY):
    """(structured, rejects, catalogue) from line_id and value.

    The lines are scanned once to mine the catalogue and once to assign it. Only shapes
    and the digit-bearing tokens are aggregated in between; parsing twice costs less than
    writing and reading a parsed copy of all text. The lines must be the same each time,
    as those of a fixed list of files are.
    """
    parsed = parse_header(lines)
    good = with_shape(accepted(parsed), masks)
    catalogue = mine_templates(good, depth, similarity)
    columns = schema.STRUCTURED.fieldNames()
    return assign_templates(good, catalogue).select(*columns), rejected(parsed), catalogue


def structure_files(spark: SparkSession, raw_path, structured_path, rejects_path=None, **options):
    """Raw log directory -> structured Parquet, partitioned by day."""
    structured, rejects, _ = structure(raw_lines(spark, raw_path), **options)
    write_structured(structured, structured_path)
    if rejects_path is not None:
        rejects.write.mode("overwrite").parquet(rejects_path)
