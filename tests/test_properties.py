"""Property tests: the merge against a plain-Python statement of the policies, on random small tables;
the checked broadcast."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from levyline import schemas
from levyline.operators.merge import merge
from levyline.operators.sizing import broadcast_if_small
from tests.helpers import make

AT = schemas.AGENT_TRANSACTIONS
EN = schemas.ENUMERATION
BASE = dt.datetime(2024, 1, 1)

rows = st.lists(
    st.tuples(
        st.integers(0, 12),  # key
        st.integers(0, 5),  # hours after BASE (event time)
        st.sampled_from([None, "Completed", "Failed"]),  # an update column
        st.sampled_from([None, "a", "b"]),  # a column that is not updated
    ),
    max_size=12,
)


def _at_rows(data, unique):
    out, seen = [], set()
    for k, h, status, comment in data:
        if unique and k in seen:
            continue
        seen.add(k)
        out.append({"idagent_transactions": k, "trans_date": BASE + dt.timedelta(hours=h), "status": status,
                    "comment": comment})
    return out


def _expected_upsert(target, slice_):
    # a new key: the earliest row with the latest row's update columns (ties: the least, the greatest whole row)
    latest, earliest = {}, {}
    for r in slice_:
        k = r["idagent_transactions"]
        key = (r["trans_date"], r["status"] or "", r["comment"] or "")
        if k not in latest or key > latest[k][0]:
            latest[k] = (key, r)
        if k not in earliest or key < earliest[k][0]:
            earliest[k] = (key, r)
    out = {r["idagent_transactions"]: dict(r) for r in target}
    for k, (_, r) in latest.items():
        if k in out:
            for c in AT.update_columns:
                out[k][c] = r.get(c)
        else:
            out[k] = dict(earliest[k][1]) | {c: r.get(c) for c in AT.update_columns}
    return {k: (v["trans_date"], v.get("status"), v.get("comment")) for k, v in out.items()}


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, slice_=rows, small=st.booleans())
def test_upsert_matches_model(spark, target, slice_, small):
    t, s = _at_rows(target, unique=True), _at_rows(slice_, unique=False)
    got = merge(make(spark, AT, t), make(spark, AT, s), AT, small_slice=small).collect()
    got = {r["idagent_transactions"]: (r["trans_date"], r["status"], r["comment"]) for r in got}
    assert got == _expected_upsert(t, s)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=rows, slice_=rows)
def test_insert_only_matches_model(spark, target, slice_):
    t = [{"id": k, "create_time": BASE + dt.timedelta(hours=h), "category": c} for k, h, _s, c in target]
    t = list({r["id"]: r for r in t}.values())
    s = [{"id": k, "create_time": BASE + dt.timedelta(hours=h), "category": c} for k, h, _s, c in slice_]
    got = {r["id"]: (r["create_time"], r["category"]) for r in merge(make(spark, EN, t), make(spark, EN, s), EN).collect()}
    want = {r["id"]: (r["create_time"], r["category"]) for r in t}
    earliest = {}
    for r in s:
        key = (r["create_time"], r["category"] or "")
        if r["id"] not in earliest or key < earliest[r["id"]][0]:
            earliest[r["id"]] = (key, r)
    for k, (_, r) in earliest.items():
        want.setdefault(k, (r["create_time"], r["category"]))
    assert got == want


def test_broadcast_only_within_the_limit(spark):
    df = spark.range(100).toDF("k")
    hinted, small = broadcast_if_small(df, row_bytes=16, limit=16 * 100)
    assert small is True
    plan = hinted.join(spark.range(1000).toDF("k"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    _, small = broadcast_if_small(df, row_bytes=16, limit=16 * 99)
    assert small is False
