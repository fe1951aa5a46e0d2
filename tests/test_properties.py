"""Properties of the merge: independent of version order, idempotent, and the union before
DISTINCT has exactly the rows of its parts."""

from hypothesis import given, settings
from hypothesis import strategies as st

from harmonia.operators import schema

TYPES = {"k": ["int", "bigint"], "a": ["string", "int"], "b": ["double", "int", "bigint"]}


@st.composite
def versions(draw):
    out = []
    for _ in range(draw(st.integers(2, 4))):
        cols = ["k"] + [c for c in ("a", "b") if draw(st.booleans())]
        types = {c: draw(st.sampled_from(TYPES[c])) for c in cols}
        rows = draw(st.lists(st.tuples(*[st.integers(0, 3) for _ in cols]), min_size=0, max_size=6))
        out.append((cols, types, rows))
    return out


def to_frames(spark, vs):
    frames = []
    for cols, types, rows in vs:
        conv = [tuple(str(v) if types[c] == "string" else (float(v) if types[c] == "double" else v)
                      for c, v in zip(cols, r)) for r in rows]
        frames.append(spark.createDataFrame(conv, ", ".join(f"{c} {types[c]}" for c in cols)))
    return frames


def rowset(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@settings(max_examples=8, deadline=None)
@given(versions())
def test_merge_properties(spark, vs):
    frames = to_frames(spark, vs)
    merged = schema.merge_versions(frames)
    cols = sorted(merged.columns)
    assert rowset(schema.merge_versions(list(reversed(frames))), cols) == rowset(merged, cols)
    assert rowset(schema.merge_versions([merged, merged]), cols) == rowset(merged, cols)
    assert schema.union_versions(frames).count() == sum(len(rows) for _, _, rows in vs)
