import pytest

from tierline import session


def test_session_defaults(spark):
    conf = spark.conf
    assert conf.get("spark.sql.session.timeZone") == "UTC"
    assert conf.get("spark.sql.adaptive.enabled") == "true"
    assert conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert conf.get("spark.sql.streaming.stateStore.providerClass").endswith("RocksDBStateStoreProvider")
    assert spark.sparkContext.getConf().get("spark.ui.enabled") == "false"


def test_no_local_scratch_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:
            @staticmethod
            def get(name, default=None):
                return default

    monkeypatch.setattr(session, "_context", lambda _: Context())
    with pytest.raises(ValueError):
        session.scratch_root(Session())


def test_iso_text_and_parsing_in_any_session_zone(spark):
    from pyspark.sql import functions as F
    from tierline.functions.timefmt import iso_text, lenient_timestamp

    texts = ["2026-01-01T03:04:05Z", "2026-03-08T02:30:00.120000", "2026-07-01 12:00:00", "2026-07-01", "bad", None]
    want = ["2026-01-01T03:04:05.000000Z", "2026-03-08T02:30:00.120000Z", "2026-07-01T12:00:00.000000Z",
            "2026-07-01T00:00:00.000000Z", None, None]
    for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
            parsed = lenient_timestamp("t")
            rows = df.orderBy("i").select(iso_text(parsed, micros=True).alias("z")).collect()
            assert [r["z"] for r in rows] == want
            wall = df.filter("i = 1").select(iso_text(F.col("t").cast("timestamp_ntz")).alias("w")).first()["w"]
            assert wall == "2026-03-08T02:30:00Z"
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
