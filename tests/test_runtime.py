from pathlib import Path

from noctule.runtime import materialize, scratch_scope


def files(df):
    return [Path(f.removeprefix("file:").replace("//", "/")) for f in df.inputFiles()]


def test_a_scope_removes_its_tables_but_kept_ones(spark):
    with scratch_scope(spark):
        with scratch_scope(spark):
            inner = files(materialize(spark.range(3)))
            outer = materialize(spark.range(4), keep=True)
        assert not any(f.exists() for f in inner)
        assert outer.count() == 4
        counts = {}
        kept = materialize(outer, "rows", counts, keep=True)
    assert counts == {"rows": 4} and kept.count() == 4
    assert not any(f.exists() for f in files(outer))
