"""Operators that return rows keep every other column's values, whatever it is named, and every clean or null row."""

import random
from collections import Counter

import pytest

from factloom.llm import decontaminate, exactdedup, jaccardjoin, linededup, mixing, suffixdedup, toxicity


def brute_spans(data, length):
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        out.append(bytes(mark))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_suffix_spans_of_overlapping_passages(spark, seed):
    """Passages cut short on either side, so that neighbours in the order of suffixes and of heads settle different windows."""
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices("abcd", k=rnd.randrange(20, 60))) for _ in range(12)]
    rows = []
    for _ in range(150):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            p = rnd.choice(pool)
            a = rnd.randrange(len(p))
            parts += [p[a : a + rnd.randrange(4, 50)], "".join(rnd.choices("abcdefgh", k=rnd.randrange(6)))]
        rows.append("".join(parts))
    docs = spark.createDataFrame([(str(i).encode(), t) for i, t in enumerate(rows)], "uid binary, text string").repartition(3)
    found = {int(bytes(r.uid)): r.spans for r in suffixdedup.repeated_spans(docs, 16, 5, 4).collect()}
    for i, want in enumerate(brute_spans([t.encode() for t in rows], 16)):
        mark = bytearray(len(want))
        for s in found.get(i, ()):
            mark[s["a"] : s["b"]] = b"\1" * (s["b"] - s["a"])
        assert bytes(mark) == want, i


def shingled(text, n):
    w = text.lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_roots(texts, n, num):
    sets = [shingled(t, n) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= num * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return [find(i) for i in range(len(texts))]


def edited_texts(rnd):
    """Chains of edits about the threshold, short and long texts, and a passage that most share."""
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = rnd.choices(vocabulary, k=25)
    out = []
    for size in (6, 9, 14, 20, 30, 45, 70, 110, 200):
        base = rnd.choices(vocabulary, k=size)
        now = base
        for i in range(14):
            now = list(now if i % 3 else base)
            for _ in range(rnd.randrange(1, 2 + size // 40)):
                now[rnd.randrange(len(now))] = rnd.choice(vocabulary)
            out.append(" ".join(now))
        for _ in range(8):
            out.append(" ".join([*rnd.choices(vocabulary, k=size // 2), *passage]))
    return out


@pytest.mark.parametrize("n,num,page", [(3, 90, 512), (5, 80, 8), (2, 70, 4)])
def test_jaccard_pages_and_chains(spark, monkeypatch, n, num, page):
    monkeypatch.setattr(jaccardjoin, "PAGE", page)
    monkeypatch.setattr(jaccardjoin, "TASK_SETS", 3)
    texts = edited_texts(random.Random(n))
    docs = spark.createDataFrame(list(enumerate(texts)), "did long, text string").repartition(3)
    found = {r.did: r.root for r in jaccardjoin.clusters(docs, n, num, 100).collect()}
    assert [found[i] for i in range(len(texts))] == brute_roots(texts, n, num)


def test_jaccard_dedup_by_row(spark):
    same, other = " ".join(f"w{i}" for i in range(40)), " ".join(f"z{i}" for i in range(40))
    rows = [(1, same, 5, "a"), (2, same + " end", 6, "b"), (2, other, 7, "c"), (3, None, 8, "d"), (3, None, 8, "d"), (None, "x y", 1, "e"), (9, "tie once", 1, "f"), (9, "tie once", 1, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Did int, UID string")
    kept = jaccardjoin.dedup(docs)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter([rows[0], *rows[2:7]])


LINE = "A line that is long enough to be held by many documents of the corpus"
PASSAGE = " ".join(f"passage{i}" for i in range(60))
CLASHES = "DOC_ID long, text string, lang string, source string, uid string, Spans int, n_hit int, n_words long, item_ids string, bitmap string, n_dropped int, score string, predicted int, did long, _did int, _sha string, _topic string, _tokens int, _u double, _source string, _lang string, key string, sid int, shard string, `odd name` int"


@pytest.fixture(scope="module")
def rows():
    texts = [None, "", "clean text of its own", "clean text of its own", f"one {PASSAGE} two", f"three {PASSAGE} four", *[f"head {i}\n{LINE}\ntail {i}" for i in range(7)], "benchmark words " + " ".join(f"q{i}" for i in range(14)) + " after", "x" * 5000]
    return [(i // 2 if i < 4 else None if i == 8 else i, t, "en", "web", "u", 1, 2, 3, "ids", "b", 4, "s", 5, 6, 7, "h", "t", 8, 0.5, "src", "lng", "k", 9, "sh", 10) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def clashing(spark, rows):
    return spark.createDataFrame(rows, CLASHES).repartition(3)


def values(df):
    return Counter(map(tuple, df.collect()))


def with_text(rows, change):
    return Counter((r[0], change(r[1]), *r[2:]) for r in rows)


def test_dedup_lines_keeps_rows(clashing, rows):
    out = linededup.dedup_lines(clashing)
    last = max(r[0] for r in rows if r[1] and LINE in r[1] and r[0] is not None)
    want = Counter((r[0], r[1].replace(LINE + "\n", "") if r[1] and LINE in r[1] and r[0] != last else r[1], *r[2:]) for r in rows)
    assert out.columns == clashing.columns and values(out) == want


def test_remove_repeats_keeps_rows(clashing, rows):
    out = suffixdedup.remove_repeats(clashing, 60, 20)
    data = [(r[1] or "").encode() for r in rows]
    marks = brute_spans(data, 60)
    left = [bytes(c for c, m in zip(b, mark, strict=True) if not m).decode() for b, mark in zip(data, marks, strict=True)]
    assert out.columns == clashing.columns
    assert values(out) == Counter((r[0], None if r[1] is None else t, *r[2:]) for r, t in zip(rows, left, strict=True))
    assert any(t != r[1] for r, t in zip(rows, left, strict=True) if r[1])


def test_cut_spans_in_several_passes(spark, clashing, rows, monkeypatch):
    item = " ".join(f"q{i}" for i in range(14))
    bench = spark.createDataFrame([("a", item), ("b", None), ("c", "tail 3"), ("d", " ".join(PASSAGE.split()[:30]))], "item_id string, text string")
    whole = decontaminate.contamination(clashing, bench)
    for limit in (decontaminate.MAX_BYTES, 1):
        monkeypatch.setattr(decontaminate, "MAX_BYTES", limit)
        assert sorted(map(str, decontaminate.contamination(clashing, bench).collect())) == sorted(map(str, whole.collect()))
        out = decontaminate.decontaminate(clashing, bench, remove="spans")
        head = " ".join(PASSAGE.split()[:30])
        cut = lambda t: t and t.replace(item, "").replace("tail 3", "").replace(head, "")
        assert out.columns == clashing.columns and values(out) == with_text(rows, cut)
        kept = decontaminate.decontaminate(clashing, bench)
        assert values(kept) == Counter(r for r in rows if cut(r[1]) == r[1])


def test_exact_dedup_keeps_rows(clashing, rows):
    smallest = {}
    for r in rows:
        key = r[0] if r[0] is not None else -1
        smallest[r[1] or ""] = min(key, smallest.get(r[1] or "", key))
    want = Counter(r for r in rows if (r[0] if r[0] is not None else -1) == smallest[r[1] or ""])
    assert values(exactdedup.dedup(clashing)) == want


def test_mix_and_toxicity_keep_rows(spark, clashing, rows):
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and set(map(tuple, mixed.collect())) <= set(rows)
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(40)], "doc_id long, toxic int")
    kept = toxicity.remove_toxic(clashing, labels)
    assert kept.columns == clashing.columns and set(map(tuple, kept.collect())) <= set(rows)
    assert values(toxicity.remove_toxic(clashing, labels.limit(0))) == Counter(rows)


def test_stream_of_lines_in_small_batches():
    """The streamed verdicts do not depend on how rows fall into batches."""
    import pyarrow as pa

    rnd = random.Random(3)
    rows = sorted((rnd.choice((0, 0, 0, 1, 2, 3, 4)), 0, rnd.randrange(12), str(i).encode(), i) for i in range(300))
    for size in (1, 2, 7, 300):
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[a : a + size], strict=True)], ["hi", "lo", "did", "uid", "pos"]) for a in range(0, len(rows), size)]
        out = [r for b in linededup._stream(5)(iter(batches)) for r in b.to_pylist()]
        n, last = Counter(), {}
        for hi, _, did, _, _ in {r[:3] + (0, 0) for r in rows}:
            n[hi] += 1
            last[hi] = max(did, last.get(hi, did))
        edge = Counter()
        for r in out:
            if not r["settled"]:
                edge[r["hi"]] += r["opens"]
        dropped = {r["pos"] for r in out if r["settled"] or (edge[r["hi"]] >= 5 and r["did"] != last[r["hi"]])}
        assert dropped == {pos for hi, _, did, _, pos in rows if n[hi] >= 5 and did != last[hi]}, size
        assert all(edge[hi] == n[hi] for hi in edge)


def test_shards_are_written_and_read_back(spark, clashing, rows, tmp_path):
    from factloom.llm import sharding

    sharding.write_shards(clashing, 3, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert set(back.columns) == {*clashing.columns, "shard_"}
    assert values(back.select(clashing.columns)) == Counter(rows)


def test_link_lists_inside_articles_are_menus():
    from factloom.llm import htmltext

    p = [" ".join(f"w{k}{i}" for i in range(n)) for k, n in enumerate((40, 35, 28))]
    links = "<ul>" + "".join(f"<li><a href=/{i}>see also part {i}</a></li>" for i in range(4)) + "</ul>"
    for page in (f"<article><p>{p[0]}</p><p>{p[1]}</p>{links}<p>{p[2]}</p></article>", f"<main><p>{p[0]}</p><p>{p[1]}</p><p>{p[2]}</p>{links}</main>", f"<div><p>{p[0]}</p>{links}<p>{p[1]}</p><p>{p[2]}</p></div>"):
        assert htmltext.main_text(page) == "\n".join(p), page
    assert htmltext.main_text(f"<article><p>{p[0]} <a href=/x>one link</a></p><p>{p[1]}</p></article>") == f"{p[0]} one link\n{p[1]}"


def test_tasks_give_their_memory_back(monkeypatch):
    from factloom.llm import common

    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    assert list(common.released(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and calls == [1]
    early = common.released(lambda batches: (b for b in batches))([1, 2])
    assert next(early) == 1
    early.close()
    assert calls == [1, 1]
    monkeypatch.undo()
    common.give_back()


def test_suffix_lookup_leaves_out_windows_that_neighbours_rule_out(spark, monkeypatch):
    """Texts that share a passage ask for windows just beyond it: other texts of the key are not looked up at all of these."""
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    texts = [word(12) + "qwertyzx" + word(12) for _ in range(60)]
    docs = spark.createDataFrame([(bytearray(i.to_bytes(2, "big")), t) for i, t in enumerate(texts)], "uid binary, text string")
    rows, real = {}, suffixdedup.written

    def counted(df, name):
        out = real(df, name)
        rows[name] = out.collect()
        return out

    monkeypatch.setattr(suffixdedup, "written", counted)
    suffixdedup.repeated_spans(docs, 16, 5, 4).collect()
    asked = {}
    for r in rows["asked"]:
        asked.setdefault(r.key, set()).update(r.ats if "ats" in r else [r.at])
    every = sum(16 - len(e["suffix"]) <= at <= len(e["head"]) for e in rows["entries"] for at in asked.get(e.key, ()))
    assert 0 < len(rows["windows"]) < 0.6 * every
