"""Scratch folders of an application."""

from pyspark.sql import functions as F

from trellis import session
from trellis.session import clear_scratch, scratch_path, stored


def test_scratch_of_the_application_is_removed_at_once(spark, monkeypatch):
    monkeypatch.setattr(session, "_scratch_root", lambda s: f"{session.ensure_checkpoint_dir(s)}/trellis-other-application")
    path = scratch_path(spark, "x")
    assert path.startswith(session._scratch_root(spark)) and path != scratch_path(spark, "x")
    kept = stored(spark.range(3).select(F.col("id")), "x")
    assert kept.count() == 3
    assert clear_scratch(spark)
    assert not clear_scratch(spark)         # nothing is left to remove
