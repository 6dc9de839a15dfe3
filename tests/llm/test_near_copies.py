"""The pipeline's near-duplicate groups against all pairs of a small corpus."""

import random
import re

import pytest


def shingle_sets(texts, width=5):
    out = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = {tuple(w[k : k + width]) for k in range(max(len(w) - width + 1, 1))} if w else set()
    return out


def groups_of(links, ids):
    low = {i: i for i in ids}

    def find(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def planted(seed, groups, copies, least=0.8):
    """Documents, and copies with words changed whose similarity to theirs is over ``least``."""
    draw = random.Random(seed)
    words = [f"w{draw.randrange(10**6)}" for _ in range(3000)]
    texts = {}
    for _ in range(groups):
        base = draw.choices(words, k=draw.randrange(60, 400))
        texts[len(texts)] = " ".join(base)
        for _ in range(copies):
            changed = base[:]
            n = max(1, int(len(base) * draw.uniform(0.004, 0.021)))
            for at in draw.sample(range(len(base)), n):
                changed[at] = draw.choice(words)
            texts[len(texts)] = " ".join(changed)
    return texts


def exact_links(texts, least=0.8):
    sets = shingle_sets(texts)
    alike = lambda x, y: len(x & y) >= least * len(x | y) if x | y else True
    ids = sorted(texts)
    return [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if alike(sets[a], sets[b])]


@pytest.mark.parametrize("chunk, groups, copies", [(1024, 60, 4), (16, 3, 90)])
def test_recall_and_precision_against_all_pairs(spark, monkeypatch, chunk, groups, copies):
    from eddyline.llm import near_copies

    monkeypatch.setattr(near_copies, "CHUNK", chunk)  # buckets of several chunks
    monkeypatch.setattr(near_copies, "CARRIED", 12)
    texts = planted(3, groups, copies)
    links = exact_links(texts)
    got = {r.doc_id: r.component_id for r in near_copies.near_copies(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}
    true = groups_of(links, texts)
    met = sum(got[a] == got[b] for a, b in links) / len(links)
    print("links:", len(links), "recall:", round(met, 4))
    assert met >= 0.95
    assert all(true[i] == true[c] for i, c in got.items())  # no group is joined that has no chain of links
    assert sum(got[i] != i for i in texts) >= 0.95 * sum(true[i] != i for i in texts)


def test_odd_documents(spark, odd, nothing):
    from eddyline.llm.near_copies import near_copies

    rows = near_copies(odd).collect()
    assert len(rows) == odd.count()
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add(r.component_id)
    assert got[1] == got[2] == got[3] == {1} and got[5] == {5} and got[4] == {4} and got[6] == {6}
    assert got[None] == {None, 1}  # one text of its own, and one without words
    assert near_copies(nothing).count() == 0


def test_a_large_bucket_loses_no_link(spark, monkeypatch):
    """With a chunk of four, one carried member and many groups in one bucket, only the pass
    over the rest joins what lies in different chunks."""
    from eddyline.llm import near_copies

    texts = planted(11, 30, 2)
    links = exact_links(texts)
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")

    def met():
        got = {r.doc_id: r.component_id for r in near_copies.near_copies(frame).collect()}
        true = groups_of(links, texts)
        assert all(true[i] == true[c] for i, c in got.items())
        return sum(got[a] == got[b] for a, b in links) / len(links)

    monkeypatch.setattr(near_copies, "BANDS", 1)
    monkeypatch.setattr(near_copies, "BAND_ROWS", 0)  # one bucket holds all documents
    monkeypatch.setattr(near_copies, "CHUNK", 4)
    monkeypatch.setattr(near_copies, "CARRIED", 1)
    assert met() == 1.0
