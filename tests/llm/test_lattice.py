import numpy as np

from cohortia.llm import lattice
from cohortia.llm.components import components


def test_shortest_vectors():
    steps = lattice.shortest_vectors()
    assert len({tuple(v) for v in steps}) == 240
    assert ((steps**2).sum(axis=1) == 2).all()
    assert np.array_equal(lattice.decode(steps), steps)


def test_decoding_finds_no_nearer_point():
    random = np.random.default_rng(1)
    x = random.normal(size=(300, 8)) * 2
    points = lattice.decode(x)
    doubled = points * 2
    assert ((doubled == np.rint(doubled)).all()) and (points.sum(axis=1) % 2 == 0).all()
    steps = lattice.shortest_vectors()
    own = ((x - points) ** 2).sum(axis=1)
    assert (own <= 1 + 1e-9).all()  # the covering radius
    around = points[:, None] + steps
    assert (own[:, None] <= ((x[:, None] - around) ** 2).sum(axis=2) + 1e-9).all()


def by_brute_force(vectors):
    good = {}
    for i, v in vectors:
        if v and all(x is not None and np.isfinite(x) for x in v) and np.any(np.array(v) != 0):
            good[i] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {i: set() for i, _ in vectors}
    for size in {len(v) for v in good.values()}:
        ids = [i for i, v in good.items() if len(v) == size]
        x = np.array([good[i] for i in ids])
        for at, row in enumerate(x):
            links[ids[at]] |= {ids[j] for j in np.flatnonzero(x @ row >= lattice.COSINE) if j != at}
    root = {}
    for i in sorted(links):
        todo = [i]
        while todo:
            j = todo.pop()
            if j not in root:
                root[j] = i
                todo += links[j]
    return {i: (len(links[i]), root[i], root[i] == i) for i in links}


def test_equals_brute_force(spark):
    random = np.random.default_rng(5)
    rows = []
    for _ in range(60):
        centre = random.normal(size=32)
        for _ in range(random.integers(1, 6)):
            rows.append((centre + random.normal(size=32) * random.uniform(0.02, 0.12)).tolist())
        if random.random() < 0.3:
            rows += [rows[-1]] * 2
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]
    odd = [None, [], [0.0] * 32, [float("nan")] * 32, [float("inf")] + [1.0] * 31, [None] * 32,
           [1.0, 0.0], [1.0, 0.01], [-1.0, 0.0], [1e-30] * 32, [1e30] * 32]
    rows += [(1000 + i, v) for i, v in enumerate(odd)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr(
        "*", "1 AS c", "2 AS unit", "3 AS key")
    found = lattice.near_duplicates(frame).collect()
    assert {r["vec_id"]: tuple(r)[1:] for r in found} == by_brute_force(rows)


def test_recall_of_links_near_the_edge(spark):
    random = np.random.default_rng(6)
    x = random.normal(size=(1_500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    off = random.normal(size=x.shape)
    off -= (off * x).sum(axis=1)[:, None] * x
    off /= np.linalg.norm(off, axis=1)[:, None]
    cosines = random.uniform(0.951, 0.99, len(x))
    near = cosines[:, None] * x + np.sqrt(1 - cosines**2)[:, None] * off
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(np.concatenate([x, near]))]
    want = by_brute_force(rows)
    assert sum(n for n, _, _ in want.values()) >= 2 * len(x)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(frame).collect()}
    assert all(got[i] <= want[i][0] for i in want)
    assert sum(got.values()) >= 0.95 * sum(n for n, _, _ in want.values())


def test_empty_and_missing_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert lattice.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, [1.0, 2.0]), (None, None), (3, [1.0, 2.0]), (3, [1.0, 2.0])], schema)
    found = sorted(map(tuple, lattice.near_duplicates(rows).collect()), key=str)
    assert found == sorted([(None, 2, 3, False), (None, 0, None, True), (3, 2, 3, True), (3, 2, 3, True)], key=str)


def test_components(spark):
    random = np.random.default_rng(2)
    pairs = [(int(a), int(b)) for a, b in random.integers(0, 300, (220, 2))]
    pairs += [(1000 + i, 1001 + i) for i in range(40)]  # a chain
    root = {}
    for a, b in pairs:
        ra, rb = root.setdefault(a, a), root.setdefault(b, b)
        for node, r in list(root.items()):
            if r in (ra, rb):
                root[node] = min(ra, rb)
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = dict(map(tuple, components(frame).collect()))
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {node: root[node] for node in linked}
