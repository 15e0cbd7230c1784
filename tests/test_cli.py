"""The command line on the derived export."""

from parity.deployment import Deployment
from trailweave.__main__ import main
from trailweave.config import EngineConfig
from trailweave.plans.pipeline import Warehouse
from trailweave.sources import adapter


def test_refresh_and_checks(spark, tmp_path, capsys):
    d = Deployment.of(spark, "/root/testdata/sf0.001")
    daily, intraday = (adapter.family_path(d._export, f) for f in ("daily", "intraday"))
    out = str(tmp_path / "wh")
    common = ["--daily", daily, "--intraday", intraday, "--out", out, "--as-of", "2024-02-15"]
    assert main(common) == 0
    code = main([*common, "--incremental", "--only", "funnel_events", "--checks"])
    printed = capsys.readouterr().out
    # events without a user id give sessions without a key
    assert code == 1 and "sessions: unique key (session_key): 1 failures" in printed
    assert Warehouse(spark, EngineConfig(adapter.DEMO.as_of_date), out).mart("funnel_events").count() > 0


def test_lazy_without_shared_folder(spark):
    """With nowhere to write, the same plans run end to end in one job."""
    whole = Deployment.of(spark, "/root/testdata/sf0.001")
    lazy = Deployment(spark, "/root/testdata/sf0.001")
    lazy.root = None
    assert lazy.warehouse is None
    from helpers import assert_same

    assert_same(lazy.mart("funnel_events"), whole.mart("funnel_events"))
