"""Water-filling against the clamp-and-share loop; whole and fractional repetitions."""

import pytest

from gustgrid.llm.water_fill import mix

SCHEMA = "doc_id long, text string, source string, _size string"


def looped(sizes, weights, cap):
    """Clamp sources above their cap and share the excess by weight until none is above."""
    total, out, free = float(sum(sizes.values())), {}, set(sizes)
    while free:
        left = total - sum(out.values())
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] >= cap * sizes[s]]
        if not over:
            out.update(share)
            break
        for s in over:
            out[s] = cap * sizes[s]
            free.discard(s)
    return out


def documents(counts):
    rows, i = [], 0
    for source, sizes in counts.items():
        for n in sizes:
            rows.append((i, " ".join(["w"] * n), source, "clash"))
            i += 1
    return rows


@pytest.mark.parametrize("counts", [
    {"a": [500] * 4, "b": [3, 4, 5], "c": [1] * 200, None: [7] * 9},
    {"a": [10], "b": [1000] * 3, "c": [2, 2], "d": [50] * 30, "e": [1]},
    {"x": [0, 0], "y": [5, 6]},
])
def test_targets_and_sums(spark, counts):
    got = mix(spark.createDataFrame(documents(counts), SCHEMA)).collect()
    order = sorted((s for s in counts if s is not None)) + ([None] if None in counts else [])
    weights = {s: i % 3 + 1 for i, s in enumerate(order)}
    sizes = {s: sum(v) for s, v in counts.items()}
    want = looped(sizes, weights, 3.0)
    assert len(got) == sum(map(len, counts.values()))
    for s in counts:
        own = [r for r in got if r.source == s]
        assert own[0]._target == pytest.approx(want[s])
        assert abs(sum(r._size * r._copies for r in own) - want[s]) <= max(counts[s]) / 2 + 1e-6
        assert all(0 <= r._copies <= 3 for r in own)


def test_reruns_nulls_and_repeats(spark):
    rows = [(1, None, "a", ""), (1, None, "a", ""), (None, "x y", None, ""), (3, "", None, ""), (4, " ", "a", "")]
    df = spark.createDataFrame(rows * 3, SCHEMA)
    one, two = sorted(map(str, mix(df).collect())), sorted(map(str, mix(df.repartition(3)).collect()))
    assert one == two and len(one) == 15
    assert mix(df.limit(0)).collect() == []
