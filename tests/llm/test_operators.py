"""Edge rows of every operator, and plain versions where SQL cannot say it."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

ODD = [None, "", "   ", "one", "a b c d e f g", "a b c d e f g", "x" * 5000, "w " * 3000, "é ü 1.2.3.4 a@b.co +1 (555) 123-4567"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, None if i % 3 else "src", None if i % 2 else "en", 1) for i, t in enumerate(ODD)] + [(4, ODD[4], "src", "en", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size long")


def test_jaccard_links_and_edges(spark, odd):
    from dimforge.llm.op7_jaccard_join import jaccard_components

    rng = random.Random(1)
    base = [f"w{rng.randrange(9999)}" for _ in range(60)]
    near = base[:30] + ["other"] + base[31:]
    extra = spark.createDataFrame([(100, " ".join(base)), (101, " ".join(near).upper()), (102, " ".join(base[::-1]))], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(odd.select("doc_id", "text").union(extra)).collect()}
    assert got[0] == (0, 0) and got[1] == (0, 1) and got[2] == (0, 2)
    assert got[5] == (3, 4) and got[3] == (1, 3)
    assert got[101] == (56, 100) and got[102] == (56, 102)


def test_jaccard_hubs_and_shared_passages_match_brute_force(spark):
    """Copies that link to their original only, copies of copies, and a passage most texts share."""
    from dimforge.llm.op7_jaccard_join import jaccard_components

    rng = random.Random(7)

    def words(n):
        return [f"v{rng.randrange(5000)}" for _ in range(n)]

    def edited(text, changes):
        out = list(text)
        for _ in range(changes):
            out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
        return out

    hub, passage, texts = words(150), words(60), []
    texts += [edited(hub, rng.choice([0, 2, 3, 4, 5, 6, 8])) for _ in range(60)]
    texts += [passage + words(rng.randint(4, 30)) for _ in range(50)]
    for _ in range(5):  # chains: each a copy of the one before
        chain = [words(120)]
        for _ in range(6):
            chain.append(edited(chain[-1], 3))
        texts += chain
    texts += rng.sample(texts, 15)
    rng.shuffle(texts)

    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    comp = list(range(len(texts)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                comp[b] = a
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(rows).collect()}
    assert got == {i: (len(sets[i]), root(i)) for i in range(len(texts))}


def test_mix_targets_and_bounds(spark):
    from dimforge.llm.op2_mixing import mix

    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 60), rng.choice(["a", "b", "c", None])) for i in range(1500)]
    got = mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == len(rows)
    total = sum(r["size"] for r in got)
    weights = {"a": 5, "b": 2, "c": 1, None: 5}
    sizes = {s: sum(r["size"] for r in got if r.source == s) for s in weights}
    left, free, target = total, set(weights), {}
    while True:  # plain resharing
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.discard(s)
    for s in weights:
        assert all(abs(r.target - target[s]) < 1e-6 * total for r in got if r.source == s)
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) < 400
    assert all(r.taken <= 3 * r["size"] for r in got)


def test_mix_edges(spark, odd):
    from dimforge.llm.op2_mixing import mix

    assert mix(odd).count() == odd.count()
    assert mix(odd.filter("false")).count() == 0


def test_edge_rows_of_the_row_wise_operators(spark, odd):
    from dimforge.llm.op1_quality_rules import quality_rules
    from dimforge.llm.op6_language_id import language_id
    from dimforge.llm.op8_pii import find_spans, spans_text

    one = quality_rules(odd)
    assert one.count() == odd.count() and one.filter("kept").count() == 0
    langs = {r.doc_id: r.lang_pred for r in language_id(odd).collect()}
    assert langs[0] == langs[1] == "und"
    spans = {r.doc_id: r.s for r in find_spans(odd).select("doc_id", spans_text(F.col("all_spans")).alias("s")).collect()}
    assert spans[0] == "" and spans[8] == "email:12:18,ip:4:11,phone:19:36"


def test_decontamination_finds_edited_copies(spark, odd):
    from dimforge.llm.op3_decontaminate import leaks

    rng = random.Random(3)
    item = [f"q{rng.randrange(500)}" for _ in range(40)]
    edited = list(item)
    edited[9], edited[25] = "changed", "words"
    docs = odd.select("doc_id", "text").union(spark.createDataFrame(
        [(50, "intro text here " + " ".join(edited).title() + ", end"), (51, " ".join(item[:4]) + " and nothing else of it at all")], "doc_id long, text string"))
    bench = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "")], "item_id long, text string")
    got = leaks(docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(50, 1)] and got[0].start_word == 3
    assert leaks(docs, bench.filter("false")).count() == 0


def test_alignment_against_plain_table():
    from dimforge.llm.op3_decontaminate import GAP, MATCH, MISMATCH, align

    rng = np.random.default_rng(5)
    for _ in range(30):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 15))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (MATCH if a[i - 1] == b[j - 1] else MISMATCH), h[i - 1][j] + GAP, h[i][j - 1] + GAP)
        assert align(a, b)[0] == max(max(r) for r in h)


def test_html_edges():
    from dimforge.llm import op4_html_text as o

    model = o.train([])
    rng = random.Random(77)
    from dimforge.llm.gbt import tree_logits

    right = wrong = 0
    for _ in range(60):
        page = o.generated_page(rng)
        nodes, runs = o.parse(page)
        want = dict(zip(map(id, nodes), o.generated_labels(page, nodes)))
        kept = dict(zip(map(id, nodes), o.decode(nodes, tree_logits(model, o.node_features(nodes, len(page))))))
        right += sum(kept[id(n)] == want[id(n)] for n, _ in runs)
        wrong += sum(kept[id(n)] != want[id(n)] for n, _ in runs)
    assert right > 0.97 * (right + wrong)
    for page in ("", "plain", "<p>a<b>c", "</p></div>", "<script>x", "<p class='x", "<!-- ", "&am", "<table><tr><td>a<td>b"):
        nodes, runs = o.parse(page)
        assert len(o.node_features(nodes, len(page))) == len(nodes)


def test_chat_layouts_and_escapes(spark):
    from dimforge.llm import op5_chat_format as c

    text = "<|im_end|>\n\\<\\| <|sep|> \\\\<|"
    rows = spark.createDataFrame([(1, text, text, None), (2, None, None, [("human", text), ("gpt", None)])],
                                 "conv_id long, prompt string, response string, conversations array<struct<`from`:string,value:string>>")
    got = c.format_chat(c.canonical_turns(rows)).select("conv_id", "layout", c.read_back(F.col("formatted")).alias("b"),
                                                       c.learned_text(F.col("formatted"), F.col("loss")).alias("l")).orderBy("conv_id").collect()
    assert [(t.role, t.text) for t in got[0].b] == [("user", text), ("assistant", text)] and got[0].l == text
    assert got[1].layout == "shared" and [(t.role, t.text) for t in got[1].b] == [("user", text), ("assistant", "")]


def test_url_edges(spark):
    from dimforge.llm.op9_url_filter import judge
    from dimforge.llm.queries import URL_RULES

    urls = [None, "", "no scheme", "http://", "https://EXAMPLE.com/en/1", "https://www.example.com/en/?q", "http://a.net/es/x#y", "http://net/esx/", "ftp://x.com"]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = [(r.host, r.path, r.rule, r.verdict) for r in judge(rows, spark.sql(URL_RULES)).orderBy("page_id").collect()]
    assert got[:4] == [("", "", None, "allow")] * 4
    assert got[4] == ("example.com", "/en/1", "example.com/en/", "block") and got[5][2:] == ("www.example.com/en/", "allow")
    assert got[6][2:] == ("net/es/", "block") and got[7][2:] == (None, "allow") and got[8] == ("x.com", "", None, "allow")


def test_quality_network_learns_and_calibrates():
    from dimforge.llm import op10_quality as q

    rng = random.Random(6)
    good = [" ".join(rng.choice(["the", "of", "and", "word", "text"]) + str(rng.randrange(9)) for _ in range(50)) for _ in range(120)]
    junk = [" ".join(rng.choice(["the", "of"]) + "***" for _ in range(50)) for _ in range(120)]
    words = q.index_vectors()[: q.SLOTS].astype(np.float32)
    x = q.pooled(good + junk, words).astype(float)
    y = np.r_[np.ones(120), np.zeros(120)]
    model = q.train(x, y, np.arange(240) % 5 == 0)
    assert ((q.sigmoid(q.logits(model, x) / model["temperature"]) > 0.5) == y).all()
    assert np.isfinite(q.pooled([None, "", " "], words)).all()
