import json
from types import SimpleNamespace

import pytest

from sparkledger import config
from sparkledger.session import ensure_checkpoint_dir


def _fake(master, configured=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: made[-1] if made else None,
                              setCheckpointDir=made.append)
    settings = {"spark.checkpoint.dir": configured} if configured else {}
    conf = SimpleNamespace(get=lambda k, d=None: settings.get(k, d), set=settings.__setitem__)
    return SimpleNamespace(sparkContext=context, conf=conf)


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_fake(master))
    assert ensure_checkpoint_dir(_fake(master, "hdfs://n/ck")) == "hdfs://n/ck"


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_makes_its_own(master):
    assert ensure_checkpoint_dir(_fake(master))


def test_feeds_and_classification_from_json(tmp_path):
    feeds, levels = tmp_path / "feeds.json", tmp_path / "levels.json"
    feeds.write_text(json.dumps({"feeds": {"parks": {"Nr": "transaction_id"}},
                                 "groups": {"parks": "Land"}, "schema_version": "v3"}))
    assert config.load_feeds(str(feeds)) == ({"parks": {"Nr": "transaction_id"}},
                                             {"parks": "Land"}, "v3")
    feeds.write_text(json.dumps({"feeds": {"parks": {"Nr": "nothing"}}, "schema_version": "v3"}))
    with pytest.raises(ValueError, match="nothing"):
        config.load_feeds(str(feeds))
    levels.write_text(json.dumps({"amount_gbp": "secret"}))
    with pytest.raises(ValueError, match="secret"):
        config.load_classification(str(levels))


def test_configuration_from_any_storage(spark, tmp_path):
    """A mount of another file system; the summary says which texts a run was configured by."""
    from feeds import landing
    from sparkledger.config import config_version, load_feeds
    from sparkledger.plans.pipeline import LayerPaths, run_configured
    from sparkledger.sources.storage import read_text
    raw, ref, out = landing(tmp_path, {"parks_spend_1.csv": "Nr,Firm,Day,Sum\n7,Oak,01/02/2031,3.50\n"})
    text = ('{"feeds": {"parks": {"Nr": "transaction_id", "Firm": "supplier_name", "Day": '
            '"payment_date", "Sum": "amount"}}, "groups": {"parks": "Green"}, "schema_version": "v7"}')
    (tmp_path / "feeds.json").write_text(text)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.depot.link./conf", f"file://{tmp_path}")
    uri = "viewfs://depot/conf/feeds.json"
    assert read_text(spark, uri) == text
    assert load_feeds(uri, spark)[2] == "v7"
    result = run_configured(spark, raw, ref, out, uri)
    assert result.total_valid == 1
    row = spark.read.json(LayerPaths(out).summary).first()
    assert row.config_version == config_version(text) != config_version(text + " ")
