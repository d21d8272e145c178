import pytest

from citysignal import session


def test_scratch_lies_below_the_configured_folder(spark):
    configured = spark.sparkContext.getConf().get(session.CHECKPOINT_CONF)
    first, second = session.scratch(spark, "x"), session.scratch(spark, "x")
    assert first != second
    if configured:
        assert first.startswith(configured)


def test_local_sessions_fall_back_to_one_temporary_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_CONF", "spark.not.configured")
    assert session.shared_dir(spark) == session.shared_dir(spark)


def test_clusters_must_name_a_shared_folder():
    class Context:
        master = "yarn"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())
