"""The result of a run as written tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdrift.operators import consensus, coverage
from holdrift.plans.joins import settled
from holdrift.plans.views import Flow, Views

DEFAULT_VIEW = "aligned"


def nested_signals(flow: Flow, per_part=1000) -> DataFrame:
    """Signals with their votes nested; one row per signal and part of its votes."""
    return flow.signals.join(consensus.nested_details(flow.details, per_part), "isin")


def payload_rows(flow: Flow, view: str) -> DataFrame:
    """Everything a view lists as JSON texts: (view, kind, body)."""
    moves = flow.moves.select(
        F.col("delta_type").alias("kind"), F.to_json(F.struct("*")).alias("body"))
    signals = nested_signals(flow)
    signals = signals.select(
        F.lit("signal").alias("kind"), F.to_json(F.struct(*signals.columns)).alias("body"))
    return moves.unionByName(signals).select(F.lit(view).alias("view"), "kind", "body")


def head_row(views: Views, status: DataFrame, universe: DataFrame, generated_at) -> DataFrame:
    """One row: dates, counts and coverage of the run as JSON text."""
    def part(df):
        return df.select(F.to_json(F.struct(*df.columns)).alias("j")).scalar()

    return coverage.coverage(status, universe).select(F.to_json(F.struct(
        F.lit(str(generated_at)).alias("generated_at"),
        F.lit(DEFAULT_VIEW).alias("default_view"),
        views.aligned_date.scalar().alias("aligned_date"),
        F.struct("*").alias("coverage"),
        part(views.aligned.dates()).alias("aligned_dates"),
        part(views.aligned.summary()).alias("aligned_summary"),
        part(views.latest.dates()).alias("latest_dates"),
        part(views.latest.summary()).alias("latest_summary"),
    )).alias("head"))


def kept(flow: Flow) -> Flow:
    """The flow with each table computed once; several outputs are written from it."""
    return Flow(*[settled(table) for table in flow])


def publish(views: Views, status: DataFrame, universe: DataFrame, folder: str,
            generated_at) -> None:
    """Writes the payload (by view and kind), its head, and the status per fund."""
    views = views._replace(latest=kept(views.latest), aligned=kept(views.aligned))
    payload = payload_rows(views.latest, "latest").unionByName(
        payload_rows(views.aligned, "aligned"))
    payload.write.mode("overwrite").partitionBy("view", "kind").text(f"{folder}/payload")
    head_row(views, status, universe, generated_at).write.mode("overwrite").text(f"{folder}/head")
    coverage.freshness(status, views.latest_stored, universe).write.mode("overwrite").json(
        f"{folder}/funds")
