"""Landing to bronze: contract, quality gate, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contracts import ACCOUNTS, CARDS, LABELS_RAW, MERCHANTS, TRANSACTIONS_RAW
from tidemark.operators.quality import GateError, GateInputs, raise_if_any, violations
from tidemark.sources.jsonl import Landed, judged, landed, read_jsonl, typed
from tidemark.sources.lake import Lake, NotPublished
from tidemark.sources.paths import hadoop_uri


@dataclass(frozen=True)
class Landing:
    """Paths of the landed JSON-lines files and of the reference entities."""

    tx: str
    labels: str
    cards: str
    accounts: str
    merchants: str


def _judge(lake: Lake, name: str, path: str, schema: T.StructType, dt: str, run_id: str) -> tuple[Landed, int, int]:
    """Parse the text once, into Parquet with the verdict of each line; rows, rejects and their numbers, counted in the written
    column of rejected lines, which is nearly all NULL."""
    target = f"{lake.root}/{lake.version_prefix(f'judged/{name}', dt, run_id)}"
    lines = judged(lake.spark.read.text(hadoop_uri(path)), schema)
    lines.write.mode("overwrite").parquet(target)
    written = lake.spark.read.schema(lines.schema).parquet(target)
    n_lines, n_rejects = written.agg(F.count(F.lit(1)), F.count("line")).first()
    return landed(written), n_lines - n_rejects, n_rejects


def ingest(lake: Lake, landing: Landing, dt: str, run_id: str, gate: bool = True) -> dict[str, str]:
    """Publish transactions and labels of one date as Parquet. With ``gate``, nothing is published when a
    line is unreadable or a rule is violated; without it, unreadable lines are published as rejects.

    The text is read and parsed in one pass per file set; the gate's rules and the published tables read the judged
    Parquet. The manifest rows come last, after everything is written and counted. A gated run whose gate fails leaves only its judged lines.
    """
    sources = {"transactions": (landing.tx, TRANSACTIONS_RAW), "fraud_labels": (landing.labels, LABELS_RAW)}
    judgements = {name: _judge(lake, name, path, schema, dt, run_id) for name, (path, schema) in sources.items()}
    if gate:
        rejected = {name: n for name, (_, _, n) in judgements.items() if n}
        if rejected:
            raise GateError("; ".join(f"{name}: {n} unreadable lines" for name, n in rejected.items()))
        entities = [
            read_jsonl(lake.spark, path, schema).rows
            for path, schema in ((landing.cards, CARDS), (landing.accounts, ACCOUNTS), (landing.merchants, MERCHANTS))
        ]
        raise_if_any(violations(GateInputs(*(part.rows for part, _, _ in judgements.values()), *entities)))
    empty = [name for name, (_, n, _) in judgements.items() if not n]
    if empty:
        raise NotPublished(f"no rows in {empty}")
    out = {}
    for name, (part, _, _) in judgements.items():
        out[name] = lake.publish(typed(part.rows), f"bronze/{name}", dt, run_id)
        if not gate:
            out[f"{name}_rejects"] = lake.publish(part.rejects, f"rejects/{name}", dt, run_id)
    return out
