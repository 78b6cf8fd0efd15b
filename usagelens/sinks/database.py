"""Result tables into a SQL database over JDBC."""

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame

from usagelens.sinks.tables import counted, require_columns

# What happens when the table already exists, as Spark names it.
WRITE_MODES = {"fail": "errorifexists", "replace": "overwrite", "append": "append"}


def jdbc_options(config: Mapping[str, Any]) -> dict[str, str]:
    """JDBC options for a PostgreSQL database; database, user and password must be given."""
    host, port = config.get("host", "localhost"), config.get("port", 5432)
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{config['database']}",
        "user": config["user"],
        "password": config["password"],
        "driver": "org.postgresql.Driver",
    }


def load_table(
    df: DataFrame,
    table: str,
    connection: Mapping[str, str],
    required: Sequence[str],
    if_exists: str = "append",
    chunksize: int = 5000,
    connections: int = 16,
    keep_definition: bool = False,
) -> int:
    """Write the ``required`` columns of ``df`` to a SQL table; returns the rows written.

    Executors write in parallel, each partition in its own transaction, over at most
    ``connections`` connections. ``keep_definition`` empties a replaced table instead of
    recreating it. A task lost between its commit and its report is run again, so after such a
    failure an append can hold rows twice; replace the table then.
    """
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {sorted(WRITE_MODES)}, not {if_exists!r}")
    rows, written = counted(require_columns(df, required))
    (
        rows.write.format("jdbc")
        .options(**connection)
        .option("dbtable", table)
        .option("batchsize", chunksize)
        .option("numPartitions", connections)
        .option("truncate", keep_definition)
        .mode(WRITE_MODES[if_exists])
        .save()
    )
    return written.get["rows"]
