import itertools
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import loan
from plumbline.functions.pvalues import kolmogorov_sf, ks_exact_sf
from plumbline.operators import association, drift, models, publish, scorecard, store, validate
from plumbline.sources import paths
from plumbline.spec import PortfolioSpec

DDL = "k long, v double, g string"


def contract(strict=True, key=("k",)):
    rules = (validate.ColumnRule("k", T.LongType(), ge=1), validate.ColumnRule("v", T.DoubleType(), nullable=True, le=9), validate.ColumnRule("g", T.StringType(), isin=("a", "b")))
    return validate.Contract(rules, {"a is small": (F.col("g") != "a") | (F.col("v") < 5)}, key, strict)


@pytest.fixture
def place(tmp_path):
    return f"file://{tmp_path}/t-{uuid.uuid4().hex}"


SOUND = [(1, 1.0, "a"), (2, None, "b"), (3, 8.0, "b")]


def test_a_sound_table_is_published_whole(spark, frame, place):
    df = frame(SOUND, DDL)
    v = publish.publish(df, contract(), place)
    assert v.kept and (v.rows, v.sound, v.repeated_keys) == (3, 3, 0) and all(n == 0 for *_, n in v.broken)
    got = spark.read.parquet(place)
    assert got.columns == df.columns and sorted(got.collect(), key=lambda r: r.k) == sorted(df.collect(), key=lambda r: r.k)
    with pytest.raises(FileExistsError):
        publish.publish(df, contract(), place)
    publish.publish(df.where("k > 1"), contract(), place, overwrite=True, partition="g")
    assert spark.read.parquet(place).count() == 2 and paths.children(spark, place)[-1].startswith("g=")


@pytest.mark.parametrize("rows,rule", [([(3, 1.0, "a")], "keys repeat"), ([(0, 1.0, "a")], "k:ge 1 rows"), ([(4, 7.0, "a"), (5, 6.0, "a")], r"\*:a is small 2 rows"), ([(None, 1.0, "b")], "k:not_null"), ([(6, 1.0, "z")], "g:isin")])
def test_a_broken_table_leaves_the_target_as_it_was(spark, frame, place, rows, rule):
    publish.publish(frame(SOUND[:1], DDL), contract(), place)
    with pytest.raises(publish.ContractBroken, match=rule) as told:
        publish.publish(frame(SOUND + rows, DDL), contract(), place, overwrite=True)
    assert told.value.verdict.rows == 3 + len(rows) and spark.read.parquet(place).count() == 1
    parent, name = place.rsplit("/", 1)
    assert paths.children(spark, parent) == [name]  # nothing staged is left


def test_columns_and_types_are_refused_before_any_work(spark, frame, place):
    extra, wrong, fewer = frame([(1, 1.0, "a", 0)], DDL + ", x int"), frame([(1, 1, "a")], "k long, v int, g string"), frame([(1, 1.0)], "k long, v double")
    for df, told in ((extra, "x: unexpected"), (wrong, "v: int instead of double"), (fewer, "g: missing")):
        with pytest.raises(publish.ContractBroken, match=told):
            publish.publish(df, contract(), place)
    assert not paths.exists(spark, place)
    assert publish.publish(extra, contract(strict=False), place).kept


def test_quarantine_takes_the_broken_rows_and_their_rules(spark, frame, place):
    df = frame(SOUND + [(4, 7.0, "a"), (5, 99.0, "z")], DDL)
    aside = place + "-aside"
    v = publish.publish(df, contract(), place, quarantine=aside)
    assert (v.rows, v.sound) == (5, 3)
    assert sorted(r.k for r in spark.read.schema(df.schema).parquet(place).collect()) == [1, 2, 3]
    assert {r.k: r.broken_rules for r in publish.quarantined(spark, df, aside).collect()} == {4: ["*:a is small"], 5: ["v:le", "g:isin"]}
    publish.publish(frame(SOUND, DDL), contract(), place, quarantine=aside, overwrite=True)
    assert publish.quarantined(spark, df, aside).count() == 0  # the older quarantine goes with the older table
    publish.publish(df.where("k > 3"), contract(), place, quarantine=aside, overwrite=True)
    assert spark.read.schema(df.schema).parquet(place).count() == 0 and publish.quarantined(spark, df, aside).count() == 2
    with pytest.raises(publish.ContractBroken, match="1 keys repeat"):
        publish.publish(df.unionByName(frame(SOUND[:1], DDL)), contract(), place + "2", quarantine=aside + "2")


def test_an_empty_table_and_a_verdict_as_a_table(spark, frame, place):
    v = publish.publish(frame(SOUND, DDL).limit(0), contract(), place)
    assert v.kept and v.rows == 0 and spark.read.schema(DDL).parquet(place).count() == 0
    with pytest.raises(publish.ContractBroken) as told:
        publish.checked(frame(SOUND + [(1, 10.0, "b")], DDL), contract())
    assert {(r.column, r.rule): r.n_bad for r in told.value.verdict.to_frame(spark).collect() if r.n_bad} == {("v", "le"): 1, ("*", "key"): 1}


SPEC = PortfolioSpec(entity_key="k", event_timestamp="at", target="y", categoricals={"g": ("a", "b")}, heavy_tailed=("x",), log_scale=("x",), winsor_quantile=0.95)


@pytest.mark.parametrize("kind,params,scale", [("logistic", {"C": 1.0, "max_iter": 20}, True), ("gbt", {"n_estimators": 2, "max_depth": 2}, False), ("forest", {"n_estimators": 3, "max_depth": 3, "min_leaf": 2}, False)])
def test_a_model_comes_back_as_it_was_saved(spark, frame, place, kind, params, scale):
    rows = [(i, float(i % 37) if i % 11 else None, i % 5 * 1.0, "ab"[i % 2], int(i % 37 > 20)) for i in range(300)]
    df = frame(rows, "k long, x double, z double, g string, y int")
    model = models.fit_candidate(df, models.Candidate(kind, kind, params, scale, {"C": models.Space("float", 0.1, 1.0)}), SPEC, "y", ["x", "z", "g"])
    assert store.save(spark, place, "m", model, 0.4, {"month": "2025-01"}) == 1
    got = store.load(spark.newSession(), place, "m")
    assert (got.version, got.threshold, got.metadata) == (1, 0.4, {"month": "2025-01"}) and got.model.candidate == model.candidate and got.model.engineer == model.engineer
    both = got.model.score(model.score(df, "a"), "b")
    assert both.where("a <> b or b is null").count() == 0


def test_versions_are_whole_or_not_seen(spark, place):
    card = loan.LOAN_CARD
    assert store.versions(spark, place, "card") == [] and store.manifests(spark, place, "card").count() == 0
    with pytest.raises(FileNotFoundError):
        store.load(spark, place, "card")
    assert [store.save(spark, place, "card", card, t) for t in (4, 7)] == [1, 2]
    spark.range(1).write.parquet(f"{place}/card/v=3/state")  # a version that another writer has not finished
    assert store.versions(spark, place, "card") == [1, 2]
    assert store.load(spark, place, "card", cards={"card": card}).model.threshold == 7 and store.load(spark, place, "card", 1, {"card": card}).threshold == 4
    assert store.save(spark, place, "card", card, 5) == 4
    assert [(r.version, r.threshold, r.kind) for r in store.manifests(spark, place, "card").orderBy("version").collect()] == [(1, 4.0, "scorecard"), (2, 7.0, "scorecard"), (4, 5.0, "scorecard")]
    other = scorecard.Scorecard({"other": card.rules["age_band"]}, 4)
    with pytest.raises(ValueError, match="rules"):
        store.load(spark, place, "card", cards={"card": other})


def plain_ks(a, b, d):
    """Share of all orders of the pooled values with a distance of d or more; equal values end together."""
    pooled = sorted(a + b)
    hit = total = 0
    for chosen in itertools.combinations(range(len(pooled)), len(a)):
        total += 1
        n1, worst = 0, 0.0
        for i, v in enumerate(pooled):
            n1 += i in chosen
            if i + 1 == len(pooled) or pooled[i + 1] != v:
                worst = max(worst, abs(n1 / len(a) - (i + 1 - n1) / len(b)))
        hit += worst >= d - 1e-12
    return hit / total


def test_exact_ks_counts_paths():
    assert (round(ks_exact_sf(0.75, 8, 8), 4), round(ks_exact_sf(0.625, 8, 8), 4)) == (0.0186, 0.0870)
    for n1, n0, d in ((3, 4, 0.5), (5, 2, 0.6), (1, 6, 5 / 6), (4, 4, 0.25), (6, 6, 1.0)):
        assert ks_exact_sf(d, n1, n0) == pytest.approx(plain_ks(list(range(n1)), list(range(n1, n1 + n0)), d))
    for a, b in (([1, 1, 2, 3], [2, 2, 3]), ([1, 1, 1], [1, 2, 2, 2]), ([5] * 4, [5] * 3)):
        pooled = sorted(a + b)
        ends = [i + 1 for i, v in enumerate(pooled) if i + 1 == len(pooled) or pooled[i + 1] != v]
        d = max(abs(sum(x <= v for x in a) / len(a) - sum(x <= v for x in b) / len(b)) for v in pooled)
        assert ks_exact_sf(d, len(a), len(b), ends) == pytest.approx(plain_ks(a, b, d))
    assert ks_exact_sf(1.0, 60, 60) == pytest.approx(2 / 96614908840363322603893139521372656)  # C(120, 60)
    assert ks_exact_sf(0.05, 2000, 1500) == pytest.approx(kolmogorov_sf(0.05 * (2000 * 1500 / 3500) ** 0.5), rel=0.05)


def test_ks_methods(frame):
    df = frame([(float(v), int(i < 8), g) for g in "pq" for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 20, 8, 9, 10, 11, 12, 13, 14, 15])], "v double, y int, g string")
    got = {m: {r.g: r.p_value for r in association.ks_test(df, "v", "y", ["g"], m).collect()} for m in ("limit", "exact", "auto")}
    assert got["exact"] == got["auto"] and got["exact"]["p"] == pytest.approx(ks_exact_sf(0.875, 8, 8)) and got["limit"]["p"] != got["exact"]["p"]
    with pytest.raises(ValueError, match="method"):
        association.ks_test(df, "v", "y", method="other")


def test_the_drift_test_is_an_argument(frame):
    ref, cur = frame([(float(i % 50),) for i in range(90)], "v double"), frame([(float(i % 50) + 30,) for i in range(60)], "v double")
    told = {t: drift.drift_report(ref, cur, numeric_test=t).first() for t in ("ks", "wasserstein", "by_size")}
    assert [told[t].method for t in told] == ["ks", "wasserstein", "ks"] and all(r.drifted for r in told.values())
    with pytest.raises(ValueError, match="numeric test"):
        drift.drift_report(ref, cur, numeric_test="best")
