"""File ledger and streamed features against fitting and transforming whole tables."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from fluxmill.operators import ledger
from fluxmill.operators.imputation import cast_users
from fluxmill.operators.profiles import fit_profile
from fluxmill.plans.feature_table import feature_table, transform
from fluxmill.sources.synthetic import synth_users
from fluxmill.streaming import features
from fluxmill.streaming import windows as live
from fluxmill.workspace import new_folder


@pytest.fixture(scope="module")
def users(spark):
    return synth_users(spark.range(0, 4_000, 1, 4), "id").persist()


def part(users, path, number, parts=4):
    users.where(F.col("user_id") % parts == number).coalesce(1).write.mode("append").parquet(f"{path}/a b+%20c/{number}")


def assert_profile(got, want):
    got, want = ({r.region: r.asDict() for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for region, row in want.items():
        for name, value in row.items():
            assert got[region][name] == (pytest.approx(value, rel=1e-9) if isinstance(value, float) else value), name


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def test_adds_a_removal_and_a_rewritten_file(spark, users, tmp_path):
    source, path = str(tmp_path / "users"), str(tmp_path / "ledger")
    ledger.start_ledger(spark, path)
    part(users, source, 0)
    part(users, source, 1)
    read = spark.read.option("recursiveFileLookup", True)
    assert ledger.update_ledger(spark, source, path) == 2
    assert_profile(ledger.ledger_profile(spark, source, path), fit_profile(cast_users(read.parquet(source))))
    # Old files could not be read any more: their listing is all that is looked at.
    old = files(source)
    kept = {}
    for name in old:
        kept[name] = open(name, "rb").read()
        stat = os.stat(name)
        open(name, "wb").write(b"\0" * len(kept[name]))
        os.utime(name, ns=(stat.st_atime_ns, stat.st_mtime_ns))
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    part(users, source, 2)
    assert ledger.update_ledger(spark, source, path) == 1
    assert ledger.update_ledger(spark, source, path) == 0
    want = users.where(F.col("user_id") % 4 < 3)
    assert_profile(ledger.ledger_profile(spark, source, path), fit_profile(cast_users(want)))
    # One file goes, another is written anew.
    shutil.rmtree(f"{source}/a b+%20c/1")
    shutil.rmtree(f"{source}/a b+%20c/0")
    part(users, source, 3)
    assert ledger.update_ledger(spark, source, path) == 1
    want = users.where(F.col("user_id") % 4 >= 2)
    assert_profile(ledger.ledger_profile(spark, source, path), fit_profile(cast_users(want)))


def test_ledger_over_many_updates(spark, users, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger.V, "FANOUT", 3)
    monkeypatch.setattr(ledger.V.compact, "__defaults__", (3,))
    source, path = str(tmp_path / "users"), str(tmp_path / "ledger")
    ledger.start_ledger(spark, path)
    for number in range(9):
        part(users, source, number, 10)
        assert ledger.update_ledger(spark, source, path) == 1
        if number == 4:
            shutil.rmtree(f"{source}/a b+%20c/0")
    want = users.where((F.col("user_id") % 10).between(1, 8))
    assert_profile(ledger.ledger_profile(spark, source, path), fit_profile(cast_users(want)))
    assert len(os.listdir(f"{path}-merged")) >= 1


def run_features(spark, users, path, numbers):
    for number in numbers:
        users.where(F.col("user_id") % 4 == number).write.mode("append").parquet(f"{path}/users")
        stream = spark.readStream.schema(users.schema).parquet(f"{path}/users")
        live.run_available(features.features_writer(stream, f"{path}/profile", f"{path}/features", f"{path}/cp"))


def test_streamed_features_equal_the_table(spark, users):
    path = new_folder(spark, "test-features")
    profile = fit_profile(cast_users(users))
    assert features.save_profile(profile, f"{path}/profile") == 0
    run_features(spark, users, path, range(4))
    got = features.read_features(spark, f"{path}/features").drop("profile_version")
    want = feature_table(users)
    assert got.columns == want.columns and got.count() == 4_000
    assert got.exceptAll(want).count() == 0


def test_a_new_profile_takes_effect_with_the_next_batch(spark, users):
    path = new_folder(spark, "test-features-two")
    first = users.where(F.col("user_id") % 2 == 0)
    features.save_profile(fit_profile(cast_users(first)), f"{path}/profile")
    run_features(spark, users, path, (0, 1))
    assert features.save_profile(fit_profile(cast_users(users)), f"{path}/profile") == 1
    run_features(spark, users, path, (2, 3))
    got = features.read_features(spark, f"{path}/features")
    for version, parts in ((0, (0, 1)), (1, (2, 3))):
        profile, number = features.load_profile(spark, f"{path}/profile", version)
        want = transform(users.where((F.col("user_id") % 4).isin(*parts)), profile)
        rows = got.where(F.col("profile_version") == number).drop("profile_version")
        assert rows.count() == 2_000 and rows.exceptAll(want).count() == 0


def test_features_need_a_profile(spark, users):
    path = new_folder(spark, "test-features-none")
    features.V.start_versions(spark, features.PROFILE, f"{path}/profile")
    with pytest.raises(Exception, match="no profile"):
        run_features(spark, users, path, (0,))
