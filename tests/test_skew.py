"""One key holding a third of all rows: results stay exact (brute force in
pandas) and the hot key is pre-aggregated before any shuffle."""

import random

import pandas as pd
import pytest

from tidewater.operators.dedup import latest_by_key
from tidewater.plans import weather

N = 6000


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(N):
        port = "HOT" if i % 3 == 0 else f"P{rnd.randint(1, 200)}"
        run = str(100 + (i % 2))
        wave = "nan" if i % 17 == 0 else f"{rnd.randint(0, 60) / 10}"
        temp = f"{rnd.randint(-50, 400) / 10}"
        rows.append((f"{port}-{run}-{i}", port, "1.0", "2.0", run, str(i), wave, temp))
    cols = ["id", "port_id", "latitude", "longitude", "ref_time", "forecast_timestamp", "wave_height",
            "sea_surface_temperature"]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).repartition(8)
    return raw, pd.DataFrame(rows, columns=cols)


def test_hot_port_summary_matches_brute_force(spark, skewed):
    raw, pdf = skewed
    ports = weather.latest_ports(
        spark.createDataFrame([("HOT", "Hot Harbor", "X", "1", "U", "1", "1", "5")],
                              "port_id string, port_name string, country string, berths string, un_locode string, "
                              "latitude string, longitude string, timestamp string")
    )
    out = weather.temperature_analysis(weather.prepare_forecast(raw), ports).toPandas().set_index("port_id")

    newest = pdf[pdf.ref_time == str(max(int(r) for r in pdf.ref_time))]
    t = newest.sea_surface_temperature.astype(float)
    expect = t.groupby(newest.port_id).agg(["mean", "min", "max", "count"])
    assert set(out.index) == set(expect.index)
    hot = out.loc["HOT"]
    assert hot.port_name == "Hot Harbor"
    assert abs(hot.avg_temp - round(expect.loc["HOT", "mean"], 2)) < 0.011
    assert hot.min_temp == expect.loc["HOT", "min"] and hot.max_temp == expect.loc["HOT", "max"]
    assert expect.loc["HOT", "count"] >= N // 6


def test_hot_key_is_reduced_before_the_shuffle(spark, skewed):
    raw, _ = skewed
    plan = weather.temperature_analysis(
        weather.prepare_forecast(raw), weather.latest_ports(raw.select("port_id", "id").withColumnRenamed("id", "port_name")
                                                             .selectExpr("*", "'1' as timestamp"))
    )._jdf.queryExecution().executedPlan().toString()
    # every aggregate has a partial (map-side) step below its exchange
    assert plan.count("partial_") >= 2


def test_latest_by_key_hot_key_matches_brute_force(spark, skewed):
    raw, pdf = skewed
    out = latest_by_key(raw, ["port_id"], ["forecast_timestamp"]).toPandas().set_index("port_id")
    best = pdf.sort_values(["forecast_timestamp", "id"]).groupby("port_id").last()
    for port in ("HOT", "P1", "P50"):
        if port in best.index:
            assert out.loc[port, "forecast_timestamp"] == best.loc[port, "forecast_timestamp"]
    assert len(out) == pdf.port_id.nunique()
