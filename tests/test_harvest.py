"""The whole lakehouse on small hand-made files."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from granary.__main__ import main
from granary.operators import learning
from granary.plans.harvest import HarvestLake
from granary.presets import harvest as h

HEADER = "STASIUN;TANGGAL;TN;TX;TAVG;RH_AVG;RR;SS;FF_X;DDD_X;FF_AVG;DDD_CAR\n"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    source = tmp_path_factory.mktemp("raw")
    (source / "weather").mkdir()
    (source / "weather/aceh.csv").write_text(
        HEADER + "S;01/01/2023;20;30;26;80;;5;3;180;2;N\nS;02/01/2023;20;30;-;81;12,5;5;3;180;2;N\n"
        "S;03/01/2022;x;30;28;82;10.5;5;3;180;2;N\nS;31/02/2023;20;30;28;83;4;5;3;180;2;N\n"
    )
    (source / "weather/kepri.csv").write_text("STASIUN;TANGGAL;TN;TX\nT;01/01/2023;24;30\nT;02/01/2023;;31\n")
    (source / "weather/other.csv").write_text(HEADER + "Z;01/01/2023;1;1;1;1;1;1;1;1;1;N\n")
    (source / "facts").mkdir()
    (source / "facts/facts.csv").write_text(
        "Provinsi,Luas Panen (ha),Produktivitas (ku/ha),Produksi (ton)\n"
        "ACEH,254287.38,55.22,1404234.82\nKep. Riau ,115.27,28.11,324.01\nDKI,0,1,2\nX,,,\nTOTAL,10213705.17,52.85,53980993.19\nIndonesia,10213705.17,52.85,53980993.19\n"
    )
    rng = random.Random(5)
    lines = ["﻿Provinsi,Tahun,Produksi,Luas Panen,Curah hujan,Kelembapan,Suhu rata-rata"]
    for p in ("Aceh", "Riau", "Lampung"):
        for year in range(1993, 2003):
            area = rng.randint(50_000, 400_000)
            lines.append(f"{p},{year},{area * 4}, {area},{rng.randint(900, 2500)},{rng.uniform(75, 85):.2f},{rng.uniform(25, 28):.2f}")
    (source / "history.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    made = HarvestLake(spark, str(tmp_path_factory.mktemp("lake")), "bronze/weather", "bronze/facts/facts.csv", "bronze/history.csv", "2024-01-01 00:00:00")
    assert tuple(made.land(str(source), ("weather", "facts")).first()) == (5, 5, 0)
    assert made.build_weather() and made.build_facts()
    return made


def test_absent_sources_are_told_not_raised(lake, spark):
    elsewhere = HarvestLake(spark, lake.base, "bronze/nothing", "bronze/nothing.csv")
    assert not elsewhere.build_weather() and not elsewhere.build_facts()


def test_silver_weather(lake):
    got = {(r.province, str(r.tanggal)): r for r in lake.table("silver/weather").collect()}
    assert set(p for p, _ in got) == {"ACEH", "KEPULAUAN RIAU"}
    first = got["ACEH", "2023-01-01"]
    assert first.rainfall == pytest.approx((125 + 10.5 + 4) / 3) and first.data_quality_score == 1.0
    assert got["ACEH", "2023-01-02"].temp_avg == pytest.approx((26 + 28 + 28) / 3)
    assert got["ACEH", "None"].humidity_avg == 83.0
    island = got["KEPULAUAN RIAU", "2023-01-02"]
    assert (island.temp_min, island.rainfall, island.data_quality_score) == (24.0, None, 0.5)


def test_silver_facts(lake):
    got = {r.provinsi: r for r in lake.table("silver/facts").collect()}
    assert set(got) == {"ACEH", "KEPULAUAN RIAU", "X", "TOTAL"}
    assert got["TOTAL"].produksi_ton == 53980993.19
    assert got["X"].data_quality_score == 0.0 and got["ACEH"].data_quality_score == 1.0


def test_validation(lake):
    got = {(r.dataset, r.metric): r.value for r in lake.validate().collect()}
    assert got["measurements", "n_rows"] == 6 and got["facts", "n_rows"] == 4
    assert got["keys", "keys_both"] == 2 and got["keys", "keys_right_only"] == 2
    assert got["measurements", "nulls_rainfall"] == 2
    assert {r.key: r.status for r in lake.key_report().collect()} == {
        "ACEH": "both", "KEPULAUAN RIAU": "both", "X": "right_only", "TOTAL": "right_only"
    }


def test_gold_from_facts_and_weather(lake):
    assert lake.build_gold(use_history=False).first().ok
    got = {r.Provinsi: r for r in lake.table("gold/features").collect()}
    assert (got["ACEH"].Tahun, got["ACEH"].Kelembapan, got["ACEH"].Produksi) == (2023, 80.5, 1404234.82)
    assert got["KEPULAUAN RIAU"].Curah_hujan is None and got["TOTAL"].Kelembapan is None


def test_factors_and_history_meet_by_the_standard_name(lake):
    lake.build_gold(use_history=False)
    lake.build_synthetic(200, noise=False)
    made = lake.table("gold/synthetic")
    assert {r.Provinsi for r in made.select("Provinsi").distinct().collect()} == {"ACEH", "KEPULAUAN RIAU", "X", "TOTAL"}
    from granary.functions.cleaning import lookup, standard_name

    factor = lookup(standard_name("p", h.ALIASES), h.FACTORS, 1.0)
    names = lake.spark.createDataFrame([("Lampung",), (" sumatera utara",), ("elsewhere",), (None,)], "p string")
    assert [r[0] for r in names.select(factor).collect()] == [1.3, 1.2, 1.0, 1.0]


def test_stages_run_from_the_command_line(lake, spark, capsys):
    main([lake.base, "facts", "validate", "--facts", lake.facts_path])
    assert "keys_both" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main([lake.base, "no-such-stage"])


def test_gold_model_and_reports(lake, spark):
    check = lake.build_gold().first()
    assert (check.written, check.read_back, check.ok) == (30, 30, True)
    gold = lake.table("gold/features")
    assert gold.columns == ["Provinsi", "Tahun", "Produksi", "Luas_Panen", "Curah_hujan", "Kelembapan", "Suhu_rata_rata"]
    assert lake.export_gold(lake.path("exported")) and spark.read.parquet(lake.path("exported")).count() == 30
    lake.build_synthetic(1500)
    sizes = {r.split: r.n for r in lake.split_report().collect()}
    assert sum(sizes.values()) == 1530 and 1150 < sizes["train"] < 1300
    assert lake.combined().count() == 1530
    means = {(r.source, r.column): r.mean for r in lake.compare_sources().collect()}
    assert means["synthetic", "Produksi"] > 3 * means["synthetic", "Luas_Panen"]  # columns met by name
    done = lake.train(
        {"GBT": learning.boosted_trees(h.TARGET, 3, 4), "LinearRegression": learning.elastic_net(h.TARGET)}
    )
    stored = lake.table("predictions")
    assert {r.Model for r in stored.select("Model").distinct().collect()} == {"GBT", "LinearRegression"}
    assert stored.where("Error_Percentage is null").isEmpty()
    assert lake.best_model_name() == done.best
    reports = lake.analyse()
    summary = {(r.section, r.metric): r.value for r in reports["summary"].collect()}
    assert summary["data", "rows_real"] == "30" and summary["data", "augmentation_factor"] == "50"
    assert summary["performance", "model"] == done.best
    assert [r.n for r in reports["prediction_statistics"].collect()] == [sizes["test"]] * 4
    back = spark.read.option("header", True).csv(lake.path("reports/error_bands"))
    assert back.agg(F.sum(F.col("n").cast("int"))).first()[0] == int(summary["performance", "test_predictions"])
    charts = lake.chart_data()
    assert charts["yearly_series"].count() == 30 and charts["trend_Luas_Panen"].first().slope is not None
