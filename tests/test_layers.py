"""Raw CSV files to the master table, run log and exports."""

import json

import pytest

from riskweave.operators import clean, sampling
from riskweave.plans import medallion
from riskweave.session import stage_path
from riskweave.sources import exports, layers, runlog


@pytest.fixture(scope="module")
def report(spark):
    folder = stage_path(spark, "raw")
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).coalesce(1).write.option("header", True).csv(f"{folder}/{name}")
    v = ", ".join(f"V{i} double" for i in range(1, 29))
    cards = [(float(3600 * i), *[0.1 * i] * 28, 10.0 * (i + 1), int(i == 4)) for i in range(12)]
    write(cards + cards[:2], f"Time double, {v}, Amount double, Class int", "creditcard")
    mobile = [(i, "TRANSFER" if i % 2 else "PAYMENT", 2000.0 * (i + 1), "C1", 5000.0, 0.0, "M1", 0.0, 0.0, int(i == 3), 0) for i in range(6)]
    write(mobile + [(9, None, 1.0, "C2", 0.0, 0.0, "M2", 0.0, 0.0, 0, 0)],
          "step int, type string, amount double, nameOrig string, oldbalanceOrg double, newbalanceOrig double, nameDest string,"
          " oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int", "paysim")
    write([(i, 86400 * i + 100, 100.0 * i + 1, int(i == 2), 77, None if i == 1 else "gmail.com", None, None) for i in range(5)],
          "TransactionID long, TransactionDT long, TransactionAmt double, isFraud int, card1 int, P_emaildomain string, R_emaildomain string, V1 double", "ieee_transaction")
    write([(0, None, "mobile"), (1, 5.0, None)], "TransactionID long, id_01 double, DeviceType string", "ieee_identity")
    spark.conf.set("riskweave.layers.dir", stage_path(spark, "layers"))
    yield {r["table"]: r for r in medallion.build_layers(spark, {n: f"{folder}/{n}" for n in medallion.RULES}).collect()}
    spark.conf.unset("riskweave.layers.dir")


def test_layer_counts(report):
    assert {n: r["rows"] for n, r in report.items()} == {
        "silver/creditcard": 12, "silver/paysim": 6, "silver/ieee_transaction": 5, "silver/ieee_identity": 2,
        "gold/creditcard": 12, "gold/paysim": 6, "gold/ieee": 5, "gold/master": 23, "TOTAL": 71,
    }
    assert report["gold/master"]["positives"] == 3


def test_gold_features(spark, report):
    cards = layers.read_layer(spark, "gold", "creditcard").orderBy("Time").collect()
    assert [r["tx_velocity_10"] for r in cards] == [*range(1, 12), 11]
    assert cards[0]["amount_zscore"] is None and cards[3]["amount_rolling_mean"] == pytest.approx(25.0)
    assert cards[5]["v_abs_sum"] == pytest.approx(28 * 0.5) and cards[5]["v1_v2_interaction"] == pytest.approx(0.25)
    mobile = layers.read_layer(spark, "gold", "paysim").orderBy("step").collect()
    assert all(r["account_drain"] == 1 and r["dest_balance_zero"] == 1 for r in mobile)
    assert [r["is_transfer"] for r in mobile] == [0, 1, 0, 1, 0, 1]
    ieee = {r["TransactionID"]: r for r in layers.read_layer(spark, "gold", "ieee").collect()}
    assert [ieee[i]["has_identity"] for i in range(5)] == [1, 1, 0, 0, 0]
    assert (ieee[0]["device_type_mobile"], ieee[1]["device_type_mobile"], ieee[2]["device_type_mobile"]) == (1, 0, None)
    assert (ieee[0]["p_email_domain_risk"], ieee[1]["p_email_domain_risk"]) == (0, 1)


def test_master_has_shared_columns(spark, report):
    master = layers.read_layer(spark, "gold", "master")
    assert set(medallion.MASTER_FEATURES) < set(master.columns)
    assert master.select("row_id").distinct().count() == 23
    assert master.where("dataset_source = 'paysim' and is_night <> 0").count() == 0


def test_run_log_and_wide_board(spark):
    name = stage_path(spark, "runs").rsplit("/", 1)[1]
    runlog.append_run(spark, "a", {"auc_roc": 0.91234567, "f1_score": 0.5}, {"depth": 4}, name=name)
    runlog.append_run(spark, "b", {"auc_roc": 0.95}, name=name)
    runlog.append_run(spark, "c", {"f1_score": 0.9}, name=name)
    rows = runlog.leaderboard_wide(runlog.read_runs(spark, name), ["auc_roc", "f1_score", "recall"]).collect()
    assert [(r["model"], r["auc_roc"], r["f1_score"], r["recall"]) for r in rows] == [("b", 0.95, None, "—"), ("a", 0.9123, 0.5, "—")]


def test_summary_json_file(spark):
    df = spark.createDataFrame([(7, "x")], "n int, s string")
    path = exports.export_summary_json(exports.summary_json(df, {"count": df["n"], "name": df["s"]}), stage_path(spark, "json"))
    assert json.loads(spark.read.text(path).first()[0]) == {"count": 7, "name": "x"}


def test_sample_export(spark):
    paths = exports.sample_export(spark.range(50), 10, "id", stage_path(spark, "sample"))
    assert spark.read.parquet(paths["parquet"]).count() == 10


def test_typed_rows_class_split_and_defaults(spark):
    df = layers.from_rows(spark, [(1, 1, 0.9), (2, 0, None)], "id int not null, y int, s double")
    assert not df.schema["id"].nullable
    pos, neg = sampling.split_by_class(df, "y")
    assert ([r["id"] for r in pos.collect()], [r["id"] for r in neg.collect()]) == ([1], [2])
    assert [tuple(r) for r in clean.pick_or_default(df, ["id", "f1"], "—").collect()] == [(1, "—"), (2, "—")]
