"""The ledger guarded by a Bloom filter (F2) against a plain anti-join."""

import pytest

from quarry.operators import bloom


@pytest.mark.parametrize("bits, pushed", [(1 << 20, 1_000), (1 << 20, 0), (256, 1_000)])
def test_new_inputs_equal_the_anti_join(spark, scratch, bits, pushed):
    path, done = scratch + "/filter", []
    for run in range(3):  # a run appends its own keys
        keys = [f"doc-{run}-{i}" for i in range(400)]
        done += keys
        bloom.append(spark.createDataFrame([(k,) for k in keys + keys[:5]], "parent string"), "parent", path, bits)
    ledger = spark.createDataFrame([(k,) for k in done], "parent string")
    batch = spark.createDataFrame([(k, 1) for k in done[::50] + done[:1]] + [(f"new-{i}", 2) for i in range(900)] + [("new-1", 3)],
                                  "parent string, n int")
    fresh, read = bloom.new_inputs(batch, ledger, path, bits=bits, pushed=pushed)
    assert sorted(r.parent for r in fresh.collect()) == sorted([f"new-{i}" for i in range(900)] + ["new-1"])
    suspects = {r[0] for r in bloom.maybe_known(batch, "parent", spark, path, bits).collect()}
    assert set(done[::50]) <= suspects
    if bits > 256:
        assert len(suspects) < len(set(done[::50])) + 20 and read.count() == len(set(done[::50]))
    else:
        assert len(suspects) > 100  # a filter that is too small: false positives, the same rows


def test_null_keys_are_new_and_numbers_are_keys(spark, scratch):
    path = scratch + "/filter"
    bloom.append(spark.createDataFrame([("1",), (None,)], "parent string"), "parent", path, 1 << 16)
    ledger = spark.createDataFrame([("1",)], "parent string")
    batch = spark.createDataFrame([(1,), (2,), (None,)], "parent long")
    fresh, _ = bloom.new_inputs(batch, ledger, path, bits=1 << 16)
    assert sorted(str(r.parent) for r in fresh.collect()) == ["2", "None"]
