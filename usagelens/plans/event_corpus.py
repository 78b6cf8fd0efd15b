"""Code files, usage events and a deprecated list derived from an ``events`` table.

Each event becomes one file, whose text depends on the event's type and its ``k`` property, so what
a scan finds in it can be stated in SQL. This is what the registered queries and the bench run on.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def event_repo() -> Column:
    return F.concat(F.lit("repo"), F.col("user_id") % 10)


def event_k() -> Column:
    return F.get_json_object("props", "$.k")


def usage_events(events: DataFrame, with_id: bool = False) -> DataFrame:
    """Each event as a call of ``<event_type>.k<k>`` in one of ten repos."""
    symbol = F.concat("event_type", F.lit(".k"), event_k())
    return events.select(
        event_repo().alias("repo"),
        F.col("event_type").alias("library"),
        symbol.alias("symbol"),
        symbol.alias("symbol_called"),
        F.col("ts").alias("event_time"),
        *([F.col("event_id").cast("string").alias("event_id")] if with_id else []),
    )


def deprecated_symbols(events: DataFrame) -> DataFrame:
    """A list of every symbol whose ``k`` is below 50; some without severity, some listed twice."""
    k = event_k().cast("int")
    listed = events.select("event_type", k.alias("k")).filter(F.col("k") < 50).distinct()
    copies = F.when(F.col("k") < 5, 2).otherwise(1)
    return listed.select("*", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select(
        F.concat("event_type", F.lit(".k"), "k").alias("symbol"),
        F.col("event_type").alias("library"),
        F.concat(F.lit("1."), "k").alias("deprecated_in"),
        F.concat(F.col("copy") + 1, F.lit(".0")).alias("removed_in"),
        F.nullif(F.col("k") % 6, F.lit(0)).alias("severity"),
        F.concat("event_type", F.lit(".new"), "k").alias("replacement"),
    )


def code_sources(events: DataFrame) -> DataFrame:
    """One file per event and three helper files per repo."""
    k = event_k()
    kind = F.col("event_type")
    content = (
        F.when(
            kind == "click",
            F.format_string("import clicklib as m\nLIMIT = 2\nm.k%s(1, sep=2, **kw)\n", k),
        )
        .when(
            kind == "view",
            F.format_string(
                "from viewlib import k%s as f, util\nclass Page: pass\nf(1, *a)\n", k
            ),
        )
        .when(
            kind == "purchase",
            F.lit(
                "import helpers\n"
                "def pay(a, b):\n"
                "    import os.path\n"
                "    return os.path.join(helpers.run(), x=print(a), b=b)\n"
            ),
        )
        .when(kind == "signup", F.lit("from .helpers import run\nrun()\n"))
        .otherwise(F.lit("import broken(\n"))
    )
    folder = (
        F.when(kind == "view", "src/views/").when(kind == "error", ".venv/lib/").otherwise("pkg/")
    )
    files = events.select(
        event_repo().alias("repo"),
        F.concat(folder, F.lit("e"), "event_id", F.lit(".py")).alias("path"),
        content.alias("content"),
    )
    helpers = F.array(
        *[
            F.struct(F.lit(path).alias("path"), F.lit(text).alias("content"))
            for path, text in [
                ("helpers.py", "def run(): pass\n"),
                ("pkg/helpers.py", "def run(): pass\n"),
                ("pkg/__init__.py", "from .helpers import run\n"),
            ]
        ]
    )
    repos = events.select(event_repo().alias("repo")).distinct()
    return files.unionByName(repos.select("repo", F.inline(helpers)))


def tangled_sources(events: DataFrame) -> DataFrame:
    """Files whose imports compete: names bound three times, a module beside a package of its name,
    star, dotted and relative imports. One file per event, one more per ``signup``, and two helper
    files per repo.
    """
    kind, k, number = F.col("event_type"), event_k(), F.col("event_id").cast("string")
    path = (
        F.when(kind == "click", F.concat(F.lit("pkg/e"), number))
        .when(kind == "view", F.concat(F.lit("lib/e"), number))
        .when(kind == "purchase", F.concat(F.lit("pkg/sub/e"), number))
        .when(kind == "signup", F.concat(F.lit("m"), number))
        .otherwise(F.concat(F.lit("r"), number))
    )
    content = (
        F.when(
            kind == "click",
            F.format_string(
                "import a%s as x\nimport b%s as x\ndef x(): pass\nx.f()\n", k, k
            ),
        )
        .when(kind == "view", F.lit("from m import *\nimport pkg.u as v\nv.go()\n"))
        .when(kind == "purchase", F.lit("from ..u import f\nf()\n"))
        .when(kind == "signup", F.format_string("import m%s\nm%s.go()\n", number, number))
        .otherwise(F.lit("from . import u\nu.g()\n"))
    )
    one = F.struct(F.concat(path, F.lit(".py")).alias("path"), content.alias("content"))
    package = F.struct(
        F.concat(path, F.lit("/__init__.py")).alias("path"), F.lit("").alias("content")
    )
    made = F.when(kind == "signup", F.array(one, package)).otherwise(F.array(one))
    files = events.select(event_repo().alias("repo"), F.inline(made))
    helpers = F.array(
        *[
            F.struct(F.lit(name).alias("path"), F.lit("def f(): pass\n").alias("content"))
            for name in ("pkg/u.py", "u.py")
        ]
    )
    repos = events.select(event_repo().alias("repo")).distinct()
    return files.unionByName(repos.select("repo", F.inline(helpers)))
