"""Every corpus operator against a brute-force version, on rows with nulls, empty texts, ties, copies and clashing columns."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from factloom.llm import decontaminate, exactdedup, htmltext, jaccardjoin, linededup, mixing, sharding, suffixdedup, toxicity, urlfilter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, did long, key string, score string, n long"
SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LINE = "A line that is long enough to be held by many documents of the corpus"


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def texts():
    rnd = random.Random(5)
    vocabulary = [f"{w}{i}" for i in range(60) for w in ("ab", "Ünd", "xyz", "Q", "été")]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.choice((1, 2, 5, 30, 90, 200)))) for _ in range(40)]
    passage = " ".join(rnd.choices(vocabulary, k=120))
    out = [*base, None, None, "", "", " \t ", "one", "one", "two words", "two  words"]
    for t in base[10:24]:
        words = t.split()
        for _ in range(3):  # near copies
            copy = list(words)
            copy[rnd.randrange(len(copy))] = "changed"
            out.append(" ".join(copy))
    out += [base[3]] * 6 + [f"{t} {passage} {t[:9]}" for t in base[:8]] + [passage + " | " + passage]
    out += [f"{base[i]}\n  {LINE}\t\n{LINE.lower() if i % 2 else LINE}\nshort\n" for i in range(7)]
    out.append(" ".join(rnd.choices(vocabulary, k=20_000)))
    return out


TEXTS = texts()
BENCH = [(f"b{i}", t) for i, t in enumerate([" ".join(TEXTS[31 % 40].split()[:12]), "ab1 ab2", None, "", "never seen anywhere in these documents at all by anyone now", TEXTS[-1][500:900], TEXTS[-1][500:900]])]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i * 3, t, "en" if i % 3 else None, "hot" if i % 2 else None, len(t or ""), 1, "k", "s", 2) for i, t in enumerate(TEXTS)], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id string, text string")


def got(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_sharding(docs):
    found = got(sharding.digest(docs))
    sizes = {i * 3: len((t or "").encode()) + 16 for i, t in enumerate(TEXTS)}
    leader = {}
    for i, t in enumerate(TEXTS):
        leader.setdefault(t, i * 3)
    groups = defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[leader[t]].append(i * 3)

    def cut(capacity):
        shard, load, place = 0, 0, {}
        for lead in sorted(groups):
            weight = sum(sizes[d] for d in groups[lead])
            if weight > capacity:
                return None
            if load + weight > capacity:
                shard, load = shard + 1, 0
            load += weight
            place.update(dict.fromkeys(groups[lead], shard))
        return place if shard < 40 else None

    low, high = 1, sum(sizes.values())
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if cut(middle) else (middle + 1, high)
    load, slots = defaultdict(int), defaultdict(list)
    for d, r in found.items():
        assert (r["size"], r["law"], r["grown_shard"]) == (sizes[d], "bytes", None)
        assert r["text_crc32"] == zlib.crc32((TEXTS[d // 3] or "").encode())
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(TEXTS) and max(load.values()) == low and set(load) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len({found[d]["shard"] for d in g}) == 1 for g in groups.values())


def test_exact_dedup(docs):
    import re

    norm = {i * 3: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in enumerate(TEXTS)}
    groups = defaultdict(list)
    for d, t in norm.items():
        groups[t].append(d)
    want = {d: dict(doc_id=d, keep_id=min(groups[t]), group_size=len(groups[t]), kept=d == min(groups[t]), text_sha256=sha(t)) for d, t in norm.items()}
    assert got(exactdedup.digest(docs)) == want


def test_exact_dedup_with_colliding_keys(docs):
    pages, want = exactdedup.duplicates(docs, capacity=2, key_bits=3), exactdedup.duplicates(docs)
    assert sorted(map(str, pages.select("did", "keep", "n").collect())) == sorted(map(str, want.select("did", "keep", "n").collect()))


def test_suffix_dedup(docs):
    data = {i * 3: (t or "").encode() for i, t in enumerate(TEXTS)}
    seen = defaultdict(int)
    for b in data.values():
        for i in range(len(b) - 399):
            seen[b[i : i + 400]] += 1
    found = got(suffixdedup.digest(docs))
    for d, b in data.items():
        mark = bytearray(len(b))
        for i in range(len(b) - 399):
            if seen[b[i : i + 400]] > 1:
                mark[i : i + 400] = b"\x01" * 400
        spans = sum(m and (not i or not mark[i - 1]) for i, m in enumerate(mark))
        assert found[d] == dict(doc_id=d, n_bytes=len(b), n_removed=sum(mark), n_spans=spans, kept_sha256=sha(bytes(c for c, m in zip(b, mark, strict=True) if not m)))


def test_mixing(docs):
    rows = list(got(mixing.digest(docs)).values())
    weighted = defaultdict(float)
    for r in rows:
        weighted[r["source"]] += r["weight"] * r["n_tokens"]
        assert 0 <= r["probability"] <= 1
    tokens = defaultdict(int)
    for r in rows:
        tokens[r["source"]] += r["n_tokens"]
    total = sum(tokens.values())
    share = {s: (t / total) ** mixing.POWER for s, t in tokens.items()}
    for s in tokens:
        assert weighted[s] / sum(weighted.values()) == pytest.approx(share[s] / sum(share.values()), abs=0.02)
    assert mixing.mix(docs).columns == docs.columns


def test_mix_reaches_the_targets(spark):
    rnd = random.Random(11)
    rows = []
    for d in range(6000):
        body = " ".join(rnd.choices(("sun", "rain", "wind"), k=rnd.randrange(5, 25)))
        body += " write to ab@cd.org" if rnd.random() < 0.02 else ""
        rows.append((d, body, "en" if rnd.random() < 0.9 else "de", "web" if rnd.random() < 0.95 else "book", 1))
    rows += [(7000 + d, "", "de", "book", 1) for d in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    values = {r[0]: {"source": r[3], "lang": r[2], "topic": "contact" if "@" in r[1] else "prose"} for r in rows}
    mixed = [(r.doc_id, len(r.text.split())) for r in mixing.mix(docs).collect()]
    for d in mixing.DIMENSIONS:
        raw, reached = defaultdict(int), defaultdict(int)
        for r in rows:
            raw[values[r[0]][d]] += len(r[1].split())
        for i, n in mixed:
            reached[values[i][d]] += n
        target = {v: n**mixing.POWER for v, n in raw.items()}
        for v in raw:
            assert reached[v] / sum(reached.values()) == pytest.approx(target[v] / sum(target.values()), abs=0.02), (d, v)
    held = {r.doc_id for r in mixing.digest(docs).filter("sampled").collect()}
    assert {i for i, _ in mixed} == held and sum(n == 0 for _, n in mixed) <= 5


URLS = ["http://EXAMPLE.com/en/7?x", "https://a.b.com/en/1#f", "ftp://example.com/en/8", "http://notexample.net", "x://example.net/de/8/9", "x://example.net/de/7", "http://ORG", "http://www.org/es/", "no scheme", "", None, "http://com/en/", "http://a.xcom/en/"]


def test_url_filter(spark):
    rules = {("com", "/en/"): "block", ("example.com", "/en/7"): "allow", ("net", "/de/"): "allow", ("example.net", "/de/8"): "block", ("org", "/es/"): "block"}
    found = urlfilter.digest(spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS)], "page_id long, url string, host int")).collect()
    for r in found:
        import re

        rest = (URLS[r.page_id] or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(LOWER)
        fits = [h + p for h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=len, default=None)
        verdict = {h + p: v for (h, p), v in rules.items()}.get(best, "allow")
        assert (r["host"], r.path, r.rule, r.verdict) == (host, path, best, verdict)
    assert len(found) == len(URLS)


def test_line_dedup(docs):
    lines = {i * 3: (t or "").split("\n") for i, t in enumerate(TEXTS)}
    holders = defaultdict(set)
    for d, ls in lines.items():
        for line in ls:
            holders[line.strip(SPACE).translate(LOWER)].add(d)
    hot = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    assert hot
    found = got(linededup.digest(docs))
    for d, ls in lines.items():
        kept = [x for x in ls if hot.get(x.strip(SPACE).translate(LOWER), d) == d]
        assert found[d] == dict(doc_id=d, n_lines=len(ls), n_dropped=len(ls) - len(kept), kept_sha256=sha("\n".join(kept)))


def shingles(text, n):
    words = [w for w in "".join(" " if c in SPACE else c for c in (text or "").translate(LOWER)).split(" ") if w]
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def linked_components(n, num):
    sets = {i * 3: shingles(t, n) for i, t in enumerate(TEXTS)}
    root = {d: d for d in sets}

    def find(d):
        return d if root[d] == d else find(root[d])

    for a in sets:
        for b in sets:
            if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return sets, {d: find(d) for d in sets}


def test_jaccard_join(docs):
    sets, roots = linked_components(3, 90)
    assert got(jaccardjoin.digest(docs)) == {d: dict(doc_id=d, n_shingles=len(s), component_id=roots[d]) for d, s in sets.items()}


def test_jaccard_dedup(docs):
    _, roots = linked_components(5, 80)
    assert len(set(roots.values())) < len({t for t in TEXTS if t})
    kept = jaccardjoin.dedup(docs, 5, 80, 100)
    assert {r.doc_id for r in kept.collect()} == set(roots.values()) and kept.columns == docs.columns


def test_decontamination(docs, bench):
    import re

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    windows = defaultdict(set)
    for item, t in BENCH:
        w = words(t)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(item)
    found = got(decontaminate.digest(docs, bench))
    for i, t in enumerate(TEXTS):
        w, hit, items = words(t), set(), set()
        for size in {len(x) for x in windows}:
            for at in range(len(w) - size + 1):
                if own := windows.get(tuple(w[at : at + size])):
                    hit.update(range(at, at + size))
                    items |= own
        assert found[i * 3] == dict(doc_id=i * 3, n_words=len(w), n_hit=len(hit), n_items=len(items), items_sha256=sha(",".join(sorted(items))), contaminated=bool(hit))
    clean = {d for d, r in found.items() if not r["contaminated"]}
    kept = decontaminate.decontaminate(docs, bench)
    assert {r.doc_id for r in kept.collect()} == clean and clean and kept.columns == docs.columns


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(1)
    plain, bad = [f"word{i}" for i in range(200)], ["vilescum", "hatefilth", "rottenpig"]
    rows, marks = [], []
    for d in range(600):
        toxic = d % 4 == 0
        words = rnd.choices(plain, k=rnd.randrange(1, 60)) + (rnd.choices(bad, k=3) if toxic else [])
        rnd.shuffle(words)
        rows.append((d, " ".join(words), "x"))
        marks.append((d, int(toxic)))
    rows += [(9001, None, "x"), (9002, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([*marks, marks[0], (None, 1), (5, None)], "doc_id long, toxic int")
    found = got(toxicity.digest(docs, labels))
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found.values())
    assert all(found[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in found)
    tested = [(found[d]["predicted"], t) for d, t in marks if found[d]["held_out"]]
    assert sum(p == t for p, t in tested) / len(tested) > 0.95
    assert toxicity.remove_toxic(docs, labels).columns == docs.columns
    assert {r["score"] for r in got(toxicity.digest(docs, labels.limit(0))).values()} == {0.0}


def test_html_extraction(spark):
    story = "The old harbour was rebuilt after the storm, and its quiet cafés &amp; shops have slowly drawn the visitors back to town."
    plain = story.replace("&amp;", "&")
    page = f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a href=/>Home</a> <a href=/a>About</a></nav><header><a href=/>Site</a></header><article><h1>A harbour rebuilt after the storm</h1><p>{story}</p>\n<p>{story}  <b>Again</b>.</p></article><aside><a href=/x>Related</a></aside><script>var a='<p>no</p>'</script><footer>Copyright</footer></body></html>"
    pages = spark.createDataFrame([(1, "u", page, 5), (2, "u", None, 5), (3, None, "", 5)], "page_id long, url string, html string, text int")
    found = {r.page_id: r for r in htmltext.digest(pages).collect()}
    assert found[1].text == f"A harbour rebuilt after the storm\n{plain}\n{plain} Again."
    assert found[1].n_chars == len(found[1].text) and (found[2].text, found[2].n_chars, found[3].text) == ("", 0, "")


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def test_html_pages_without_article():
    def links(*sizes):
        return "<ul>" + "".join(f"<li><a href=/x>{words(n, 900)}</a></li>" for n in sizes) + "</ul>"

    def blocks(*sizes):
        return [words(n, 100 * i) for i, n in enumerate(sizes)]

    def page(texts, before="", after=""):
        return f"<html><body>{before}<div><h1>{texts[0]}</h1>{''.join(f'<p>{t}</p>' for t in texts[1:])}</div>{after}</body></html>"

    for sizes in ((8, 25, 30), (8, 12, 19, 15, 21), (5, 21, 17, 20), (10, 60, 5, 45, 33), (6, 14, 13, 16, 18, 12), (9, 120, 300), (7, 35, 6)):
        texts = blocks(*sizes)
        for before in ("", links(1, 2, 1), links(3, 8, 5)):
            for after in ("", links(4, 2, 3), links(24, 30, 26)):
                assert htmltext.main_text(page(texts, before, after)) == "\n".join(texts), (sizes, before, after)
    long = blocks(7, 40)
    assert htmltext.main_text(page([*long, "<a href=/a>" + words(30, 500) + "</a>"])) == "\n".join(long)  # links after long text
    assert htmltext.main_text(f"<div>{links(2, 3, 2)}<h3>More of it</h3>{links(6, 8, 5, 12)}</div>") == ""
    whole = blocks(8, 30, 14, 40)
    linked = f"<article><h1>{whole[0]}</h1><p>{whole[1]}</p><p><a href=/a>{whole[2]}</a></p><p>{whole[3]}</p></article>"
    assert htmltext.main_text(linked) == "\n".join(whole)


def test_html_containers_named_like_boilerplate():
    head, first, second, third = words(6), words(30, 100), words(26, 200), words(45, 300)
    story, plain = f"<h1>{head}</h1><p>{first}</p><p>{second}</p>", "\n".join((head, first, second))
    small = "<nav><a href=/>Home</a></nav>"
    around = ['<div class="content-sidebar-wrap">{}</div>', '<div class="no-sidebar">{}</div>', '<form id="aspnetForm">{}</form>', '<div id="search-results">{}</div>', '<div class="page-header widget">{}</div>', '<div class=sidebar>{}</div>']
    for outer in around:
        for inner in ("<main>{}</main>", "<article>{}</article>", "<div>{}</div>"):
            assert htmltext.main_text(f"<body>{small}{outer.format(inner.format(story))}<footer>{words(9)}</footer></body>") == plain, (outer, inner)
    section = f'<section id="social-policy"><h2 id="share-of-votes">Share of votes</h2><p>{third}</p></section>'
    for tag in ("article", "main", "div"):
        assert htmltext.main_text(f"<{tag}>{story}{section}</{tag}>") == f"{plain}\nShare of votes\n{third}", tag
    assert htmltext.main_text(f'<article>{story}<div class="social-policy"><p>{third}</p></div></article>') == f"{plain}\n{third}"
    assert htmltext.main_text(f'<article>{story}<div class="share-this"><a href=/x>Mail</a><p>Send it</p></div></article>') == plain
    comments = "".join(f'<article class="comment-body"><p>{words(20, 800 + i)}</p></article>' for i in range(2))
    for kind in ("sidebar", "ad", "related-posts", "cookie-consent", "site-footer"):
        assert htmltext.main_text(f'<div class="{kind}"><p>{words(24, 700)}</p></div><div>{story}</div>') == plain, kind
        assert htmltext.main_text(f'<article>{story}<div class="{kind}"><p>{words(24, 700)}</p></div></article>') == plain, kind
    assert htmltext.main_text(f'<article>{story}<p>{third}</p></article><div id="comments">{comments}</div>') == f"{plain}\n{third}"
    assert htmltext.main_text(f'<div>{story}</div><div hidden>{words(25, 700)}</div><header>{words(12, 700)}</header>') == plain


def test_html_tree_tests_link_density():
    def tested(tree):
        return set() if isinstance(tree, int) else {htmltext.FEATURES[tree[0]]} | tested(tree[2]) | tested(tree[3])

    assert {"words", "links", "words_before", "words_after", "links_before", "links_after"} <= tested(htmltext.default_tree())


OVER_DOCS = [sharding.digest, exactdedup.digest, suffixdedup.digest, mixing.digest, linededup.digest, jaccardjoin.digest]


@pytest.mark.parametrize("digest", OVER_DOCS, ids=lambda f: f.__module__.rsplit(".", 1)[1])
def test_empty_tables_and_null_rows(spark, docs, digest):
    assert digest(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None,) * 9, (None,) * 9, (7, "a b c d e f", *[None] * 7), (7, "a b c d e f", *[None] * 7)], SCHEMA)
    assert digest(nulls).count() == 4


def test_empty_tables_of_the_others(spark, docs, bench):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert decontaminate.digest(docs.limit(0), bench).count() == 0
    assert decontaminate.digest(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert toxicity.digest(docs.limit(0), labels).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert htmltext.digest(pages).count() == 0 and urlfilter.digest(pages).count() == 0


def test_pipeline(spark, docs, bench, tmp_path):
    import corpus_pipeline

    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    plain.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    plain.select("doc_id", F.lit(0).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    _, roots = linked_components(5, 80)
    dirty = {d for d, r in got(decontaminate.digest(docs, bench)).items() if r["contaminated"]}
    left = spark.createDataFrame([(d, t) for d, t in ((i * 3, t) for i, t in enumerate(TEXTS)) if d in set(roots.values()) - dirty], "doc_id long, text string")
    clean = mixing.mix(plain.join(left.select("doc_id"), "doc_id"))
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == {r.doc_id for r in clean.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, plain, str(tmp_path)).columns == plain.columns


def mixed_by_hand(rows):
    """doc_id -> how often the mix holds it; rows: (doc_id, text, lang, source), no text without words or with a topic but contact."""
    total = sum(len(t.split()) for _, t, _, _ in rows)
    cell = {d: (source, lang, "contact" if "@" in t else "prose") for d, t, lang, source in rows}
    tokens = defaultdict(float)
    for d, t, _, _ in rows:
        tokens[cell[d]] += len(t.split())
    weight = dict(tokens)
    marginal = lambda of, k: {v: sum(n for c, n in of.items() if c[k] == v) for v in {c[k] for c in of}}
    target = []
    for k in range(3):
        flat = {v: n**0.5 for v, n in marginal(tokens, k).items()}
        target.append({v: x * total / sum(flat.values()) for v, x in flat.items()})
    for _ in range(10):
        for k in range(3):
            now = marginal(weight, k)
            weight = {c: w * target[k][c[k]] / now[c[k]] for c, w in weight.items()}
    low, high = 0.0, 1e6
    for _ in range(200):
        rate = (low + high) / 2
        low, high = (rate, high) if sum(min(n, rate * weight[c]) for c, n in tokens.items()) < 0.8 * total else (low, rate)
    out = {}
    for d in cell:
        copies = rate * weight[cell[d]] / tokens[cell[d]]
        out[d] = int(copies) + (int(hashlib.md5(str(d).encode()).hexdigest()[:12], 16) / 16**12 < copies % 1)
    return out


def test_pipeline_against_independent_code(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(23)
    vocabulary = [f"{a}{b}{c}" for a in ("mor", "tal", "vin", "sel", "pra", "du") for b in ("en", "ig", "os", "ul") for c in ("da", "ter", "mi", "ko", "ba", "res", "lin")]
    rude = ["grobwort", "schmaehung", "poebelei", "lumpenkerl"]
    rows, toxic = [], set()
    for d in range(1200):
        words = rnd.choices(vocabulary, k=rnd.randrange(30, 70))
        if d % 4 == 0:
            toxic.add(d)
            words += rnd.choices(rude, k=8)
            rnd.shuffle(words)
        elif rnd.random() < 0.05:
            words.append("an@sie.de")
        rows.append((d, " ".join(words), "en" if rnd.random() < 0.85 else "de", "web" if rnd.random() < 0.9 else "book"))
    item = rows[1][1]
    copies = [(2000 + d, rows[d][1] + " ende", rows[d][2], rows[d][3]) for d in (2, 3, 5)]
    docs = rows + copies
    spark.createDataFrame([(*r, len(r[1])) for r in docs], "doc_id long, text string, lang string, source string, n_chars int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", item)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(r[0], 0, int(r[0] in toxic)) for r in docs if r[0] % 3], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    kept = [r for r in rows if r[0] not in toxic and r[0] != 1]
    want = {d: n for d, n in mixed_by_hand(kept).items() if n}
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    count = defaultdict(int)
    for r in found:
        count[r.doc_id] += 1
    assert not toxic & set(count) and len(toxic) == 300  # two in three are labelled, all go
    assert max(want.values()) > 1 and dict(count) == want

    size = {d: len(t.encode()) + 16 for d, t, _, _ in rows}
    groups = [size[d] * n for d, n in sorted(want.items())]

    def shards(capacity):
        used, load = 1, 0
        for g in groups:
            used, load = (used + 1, g) if load + g > capacity else (used, load + g)
        return used

    low, high = max(groups), sum(groups)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if shards(middle) <= corpus_pipeline.SHARDS else (middle + 1, high)
    load, slots, last = defaultdict(int), defaultdict(list), -1
    for r in sorted(found, key=lambda r: (r.shard, r.slot)):
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert r.doc_id >= last and r.size == size[r.doc_id]
        last = r.doc_id
    assert max(load.values()) == low and set(load) <= set(range(corpus_pipeline.SHARDS))
    assert all(s == list(range(len(s))) for s in slots.values())
