import numpy as np
import pyarrow as pa
import pytest

from stellate.llm import near
from stellate.llm.near import Shingler, components, near_groups
from tests.llm.helpers import corpus, frame, prose


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs):
    sets = [(i, shingles(t)) for i, t in docs]
    least = list(range(len(docs)))
    comp = [i for i, _ in sets]
    changed = True
    links = [(a, b) for a in least for b in range(a) if sets[a][1] and sets[b][1] and 100 * len(sets[a][1] & sets[b][1]) >= 75 * len(sets[a][1] | sets[b][1])]
    while changed:
        changed = False
        for a, b in links:
            m = min(comp[a], comp[b])
            changed |= comp[a] != m or comp[b] != m
            comp[a] = comp[b] = m
    return sorted((i, len(s), c, i == c) for (i, s), c in zip(sets, comp, strict=True))


def test_matches_brute_force(spark):
    docs = corpus()
    rows = near_groups(frame(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows)) == brute(docs)


def test_star_keeps_links_that_its_hub_does_not_see(spark):
    """Copies of one text that are each like the original and not like each other, so that
    whichever is the hub, the others hang on the original alone."""
    from tests.llm.helpers import prose

    base = prose(1, 200).split()
    docs = [(50, " ".join(base))]
    for i in range(9):
        words = list(base)
        for k in range(6):
            words[i * 20 + 3 * k] = f"own{i}x{k}"
        docs.append((i, " ".join(words)))
    rows = near_groups(frame(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows)) == brute(docs)


def test_later_hub_rounds(spark, monkeypatch):
    """With one hub a round the loop must reach the same result."""
    monkeypatch.setattr(near, "HUBS", 1)
    docs = corpus()[:80]
    rows = near_groups(frame(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows)) == brute(docs)


def in_one_bucket(monkeypatch):
    signatures = near._signatures

    def one_bucket(batches):
        for b in signatures(batches):
            bands = [[0] if n else [] for n in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(bands, pa.list_(pa.int64())), b.column(4)], names=b.schema.names)

    monkeypatch.setattr(near, "_signatures", one_bucket)


@pytest.mark.parametrize("block", [400_000, 300])
def test_rounds_grow_and_blocks_are_bounded(spark, monkeypatch, block):
    """Sixty outsiders of one bucket in three rounds of two, sixteen and all others; blocks of
    few shingles leave the result as it is."""
    in_one_bucket(monkeypatch)
    monkeypatch.setattr(near, "HUBS", 2)
    monkeypatch.setattr(near, "BLOCK_SHINGLES", block)
    names, staged = [], near.staged

    def noted(df, name):
        names.append(name)
        return staged(df, name)

    monkeypatch.setattr(near, "staged", noted)
    docs = [(900 + i, " ".join([*prose(1, 60).split()[:-1], f"main{i}"])) for i in range(20)]
    docs += [(10 * f + k, prose(100 + f, 50) + f" tail{k}") for f in range(30) for k in range(2)]
    rows = near_groups(frame(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(tuple, rows)) == brute(docs)
    assert 1 <= names.count("near-found") <= 4


@pytest.mark.parametrize("several", [False, True])
def test_long_copies_beside_a_more_famous_hub_and_short_subsets(spark, monkeypatch, several):
    """All classes in one bucket: the star sees only the hub, and short classes must not keep
    the long copies from becoming hubs; also where a repeated doc_id has sets of several sizes."""
    in_one_bucket(monkeypatch)
    main, long = prose(1, 300).split(), prose(2, 400).split()
    docs = [(900 + i, " ".join([*main[:-1], f"main{i}"])) for i in range(30)]  # the greatest ids: the hub is one of them
    docs += [(100 + i, " ".join([*long[: 200 + 20 * i], f"long{i}", *long[200 + 20 * i :]])) for i in range(4)]
    docs += [(200 + i, " ".join(long[i * 30 : i * 30 + 100])) for i in range(10)]
    if several:
        docs += [(300, " ".join(long[:60])), (300, " ".join(long[:-2]))]
    rows = near_groups(frame(spark, docs)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert {r["component_id"] for r in rows if 100 <= r["doc_id"] < 104} == {100}
    if not several:
        assert sorted(map(tuple, rows)) == brute(docs)


def test_null_ids_and_empty_table(spark):
    rows = near_groups(frame(spark, [(None, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == [("1", "1", True), ("2", "1", False), ("None", "None", True)]
    assert near_groups(frame(spark, [])).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a bigint, b bigint")
    assert {r["node"]: r["comp"] for r in components(links, "t").collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_word_hashes_tell_words_apart():
    words = sorted({f"{a}{b}{c}" for a in "abcdeé" for b in "xyz01" for c in ("", "a", "aa", "ab", "ba", "bb")})
    hashes, counts = Shingler().word_hashes([" ".join(words), None, "a\x0bb"])
    assert len(set(hashes[: len(words)].tolist())) == len(words)
    assert counts.tolist() == [len(words), 0, 2]


@pytest.mark.parametrize("n", [3, 40, 400, 4000])
def test_signature_agreement_estimates_similarity(n):
    """Bins of two sets agree as often as the sets are alike, also where most bins are densified."""
    shingler = Shingler()
    rng = np.random.default_rng(n)
    agree = []
    for _ in range(30):
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64))
        a, b = np.sort(pool[: int(1.2 * n)]), np.sort(pool[int(0.2 * n) : int(1.4 * n)])
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        single = Shingler.__new__(Shingler)
        single.__dict__.update(shingler.__dict__)
        single.bands, single.rows = shingler.bins, 1
        single.band_factors, single.band_salt = shingler.band_factors[:1], np.zeros(shingler.bins, np.uint64)
        agree.append((single.band_values(a) == single.band_values(b)).mean() - real)
    assert abs(np.mean(agree)) < 0.08
