from __future__ import annotations

import datetime as dt
import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from basketlens.session import local_session  # noqa: E402

TX = "t_dat date, customer_id string, article_id string, price double, sales_channel_id int"


@pytest.fixture(scope="session")
def spark():  # noqa: ANN201
    session = local_session(8, shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def new_files(spark):  # noqa: ANN001, ANN201
    """A function that returns {name of a written table: files in it} of the tables written since; many partitions, none merged."""
    from basketlens.plans.workspace import scratch_path

    folder = pathlib.Path(scratch_path(spark, "x").removeprefix("file:")).parent
    before = set(folder.glob("*"))
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield lambda: {t.name.rpartition("-")[0]: len([*t.glob("part-*")]) for t in sorted(set(folder.glob("*")) - before)}
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="session")
def make_tx(spark):  # noqa: ANN001, ANN201
    """Transactions from (day, customer, article[, price[, channel]]) tuples."""

    def build(rows):  # noqa: ANN001, ANN202
        full = [
            (
                dt.date.fromisoformat(r[0]) if r[0] else None,
                r[1],
                r[2],
                r[3] if len(r) > 3 else 0.05,
                r[4] if len(r) > 4 else 1,
            )
            for r in rows
        ]
        return spark.createDataFrame(full, TX)

    return build


@pytest.fixture(scope="session")
def lists():  # noqa: ANN201
    """{customer: [articles by rank]} of a recommendation table."""

    def collect(recs, rank="rank"):  # noqa: ANN001, ANN202
        out: dict[str, list[str]] = {}
        for r in sorted(recs.collect(), key=lambda r: (r["customer_id"], r[rank])):
            out.setdefault(r["customer_id"], []).append(r["article_id"])
        return out

    return collect
