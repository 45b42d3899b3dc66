"""Random change sequences: the Spark fold equals a brute-force model of the
semantics (per key and field, the op with the highest (position, seq) that
carries the field wins, NULL included; deletes set deleted_at)."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.operators import fold as fo
from changeflow.operators.ops import to_ops
from changeflow.sources.feed import parse_feed
from changeflow.specs import TableSpec

NOTES = TableSpec("notes", "note_id", (("note_id", "bigint"), ("title", "string"), ("body", "string")))

FIELDS = ["title", "body"]

op_st = st.fixed_dictionaries({
    "pk": st.integers(1, 3),
    "lsn": st.integers(1, 6),
    "delete": st.booleans(),
    "fields": st.dictionaries(st.sampled_from(FIELDS),
                              st.one_of(st.none(), st.sampled_from(["a", "b", "c"])), max_size=2),
})


def _line(i, op):
    if op["delete"]:
        change = {"action": "D", "table": "notes", "timestamp": f"2024-01-01 00:00:{op['lsn']:02d}+00",
                  "identity": [{"name": "note_id", "type": "bigint", "value": op["pk"]}]}
    else:
        cols = [{"name": "note_id", "type": "bigint", "value": op["pk"]}]
        cols += [{"name": k, "type": "text", "value": v} for k, v in op["fields"].items()]
        change = {"action": "U", "table": "notes", "columns": cols,
                  "identity": [{"name": "note_id", "type": "bigint", "value": op["pk"]}]}
    return json.dumps({"lsn": f"0/{op['lsn']:X}", "seq": i, "change": change})


def _model(ops):
    best = {}
    for i, op in enumerate(ops):
        order = (op["lsn"], i)
        carried = {"deleted_at": f"00:{op['lsn']:02d}"} if op["delete"] else dict(op["fields"])
        row = best.setdefault(op["pk"], {"_lsn": op["lsn"]})
        row["_lsn"] = max(row["_lsn"], op["lsn"])
        for f, v in carried.items():
            if f not in row or order > row[f][0]:
                row[f] = (order, v)
    return {pk: {f: (r[f][1] if f in r else None) for f in FIELDS + ["deleted_at"]} | {"_lsn": r["_lsn"]}
            for pk, r in best.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(op_st, min_size=1, max_size=8))
def test_fold_matches_model(spark, ops):
    lines = [_line(i, op) for i, op in enumerate(ops)]
    feed = parse_feed(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = fo.coalesce(to_ops(feed, NOTES), NOTES.fields).collect()
    out = {}
    for r in got:
        d = r["deleted_at"]
        out[r["pk"]] = {"title": r["title"], "body": r["body"],
                        "deleted_at": None if d is None else d.strftime("%M:%S"), "_lsn": r["_lsn"]}
    assert out == _model(ops)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(op_st, min_size=2, max_size=8), st.data())
def test_two_batches_any_order_equal_one_pass(spark, ops, data):
    cut = data.draw(st.integers(1, len(ops) - 1))
    lines = [_line(i, op) for i, op in enumerate(ops)]

    def folded(ls):
        feed = parse_feed(spark.createDataFrame([(x,) for x in ls], "value string"))
        return fo.coalesce(to_ops(feed, NOTES), NOTES.fields)

    def rows(df):
        return sorted((tuple(r) for r in df.select(*fo.target_columns(NOTES.fields)).collect()),
                      key=repr)

    one = fo.coalesce_to_target(folded(lines), NOTES.fields)
    a, b = folded(lines[:cut]), folded(lines[cut:])
    ab = fo.apply(fo.coalesce_to_target(a, NOTES.fields), b, NOTES.fields)
    ba = fo.apply(fo.coalesce_to_target(b, NOTES.fields), a, NOTES.fields)
    layers = [fo.coalesce_to_target(x, NOTES.fields) for x in (b, a, b)]     # merge on read, one layer twice
    merged = fo.merge_states(layers[0].unionByName(layers[1]).unionByName(layers[2]), NOTES.fields)
    assert rows(ab) == rows(one) == rows(ba) == rows(merged)
