"""The text operators against brute force, and over awkward rows."""

import base64
import collections
import pickle
import random
import re
import time
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from candlework.llm import (
    catalog, chat, classifier, decontaminate, graph, html_text, jaccard, langid, pieces, pii, quality_rules, sharding,
)
from tests.llm import brute


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_quality_measures(spark, table, awkward, empty):
    for docs in (table("documents"), awkward):
        texts = [r["text"] for r in docs.select("text").collect()]
        got = collections.Counter(r[1:7] for r in rows(quality_rules.quality_digest(quality_rules.judged(docs))))
        assert got == collections.Counter(map(brute.measures, texts))
    assert quality_rules.judged(empty).count() == 0


def test_common_lines_are_removed_and_depleted_documents_rejected(spark):
    body = lambda i: " ".join(f"a{i}b{j}" for j in range(60))
    docs = [(i, f"Shared  LINE\n{body(i)}", None, "h", 0) for i in range(20)]
    docs += [(20, "shared line\n" * 40, None, "h", 0), (21, body(21), None, "h", 0), (22, f"shared line\n{body(22)}", None, "g", 0)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r for r in quality_rules.judged(df).collect()}
    assert got[0]["kept"] and got[0]["clean_text"] == body(0) and got[0]["n_common_words"] == 2
    assert not got[20]["kept"] and got[21]["kept"]
    # The line is not common at the other host; copies of a text count as one document.
    assert got[22]["clean_text"].startswith("shared line")
    copies = spark.createDataFrame([(i, f"only\n{body(0)}", None, "h", 0) for i in range(30)], df.schema)
    assert quality_rules.judged(copies).where("kept").count() == 30


def test_decontamination(spark, table, awkward, empty):
    bench = [(r["item_id"], r["text"]) for r in table("benchmark").collect()]
    odd = [(100, "One"), (101, None), (102, ""), (None, "no id"), (103, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11"), (103, "x y")]
    for docs, items in ((table("documents"), bench), (awkward, odd)):
        benchmark = spark.createDataFrame(items, "item_id bigint, text string")
        expected = brute.passages([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], items)
        got = rows(decontaminate.decontamination_digest(decontaminate.find_passages(docs, benchmark)))
        assert collections.Counter(got) == collections.Counter(expected)
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find_passages(awkward, none).where("n_hit > 0").count() == 0
    assert decontaminate.find_passages(empty, none).count() == 0


def test_only_places_of_prefix_shingles_are_written(spark):
    """An item of one frequent word costs a word a place; long items only the places of their rarest shingles."""
    text = " ".join(["the"] * 400 + ["a b c d e rare f g h i j k"] + ["the"] * 400)
    docs = [(i, text) for i in range(30)] + [(99, "c d e rare f g h i j k the the")]
    items = [(1, "the"), (2, "a b c d e rare f g h i j k"), (3, "not there at all in any of the documents here")]
    written = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(decontaminate, "stored", lambda df, name, s=decontaminate.stored: written.append((name, s(df, name))) or written[-1][1])
        got = decontaminate.find_passages(
            spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
        )
        digest = rows(decontaminate.decontamination_digest(got))
    assert collections.Counter(digest) == collections.Counter(brute.passages(docs, items))
    hits = dict(written)["hits"].select(F.explode("hits").alias("h")).select("h.*")
    assert hits.agg(F.sum(F.length("context"))).first()[0] < 4 * 802 * 30 + 31 * 200


def test_sharding(spark, table, awkward, empty):
    for docs in (table("documents"), awkward):
        got = sharding.assign_shards(docs).collect()
        texts = [(r["text"] or "").encode() for r in docs.select("text").collect()]
        assert sorted((r["size"], r["text_crc32"]) for r in got) == sorted((len(t) + 8, zlib.crc32(t)) for t in texts)
        slots = collections.defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.assign_shards(empty).count() == 0


def test_shards_are_written_whole(spark, table, tmp_path):
    sharding.write_shards(table("documents"), f"{tmp_path}/s", 5)
    assert spark.read.parquet(f"{tmp_path}/s").count() == table("documents").count()


def test_classifier(spark, sf_dir, table, awkward, empty):
    got = catalog.QUERIES["op4_quality_classifier"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)
    vectors = classifier.word_vectors(empty)
    net = classifier.train(empty, table("labels").limit(0), vectors)
    assert all(0 <= s <= 1 for _, s in rows(classifier.score(awkward, vectors, net)))


def test_html(spark):
    tree = html_text.grow(html_text.TABLE)
    assert all(html_text.decide(tree, r) == bool(r[-1]) for r in html_text.TABLE)
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><nav><a href=1>Home</a></nav>'
        '<div class="ad">Buy this now, it is cheap</div><article><h1>A &amp; B</h1><p>One&nbsp;two <b>x</b>y<br>z'
        '<p title="a>b">Short.</p><!-- <p>no</p> --><script>var t="</p>";</script><form>Mail</form>'
        '<div class="comments"><p>Nice post, thank you for it!</p></div></article><footer>&copy; 2020</footer></body>'
    )
    cases = [(page, "A & B\nOne two xy z\nShort."), (None, ""), ("", ""), ("<", ""), ("<article>a < b <i", "a < b"),
             ('<article><p a="x' + "y" * 1000, ""), ("<article>" + "<div>" * 5000 + "deep", "deep")]
    df = spark.createDataFrame([(i, None, h) for i, (h, _) in enumerate(cases)], "page_id bigint, text string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(df).collect()}
    assert got == {i: t for i, (_, t) in enumerate(cases)}


ARTICLE = "<h1>The valley and its people</h1>" + "".join(
    f"<p>{' '.join(f'word{i}x{j}' for j in range(40))}.</p>" for i in range(4)
)
ARTICLE_TEXT = "The valley and its people\n" + "\n".join(
    " ".join(f"word{i}x{j}" for j in range(40)) + "." for i in range(4)
)
MENU, LEGAL = "<nav><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></nav>", "<footer>&copy; 2020 all rights reserved</footer>"


@pytest.mark.parametrize(
    "page",
    [
        '<div style="overflow:hidden"><article>{}</article></div>',
        '<article title="The hidden valley">{}</article>',
        '<article data-id="social">{}</article>',
        "<article data-x='class=\"comments\"'>{}</article>",
        '<article data-hidden="false">{}</article>',
        '<div class="no-ads"><article>{}</article></div>',
        '<div class="layout has-sidebar"><article>{}</article><div class="sidebar">Read this too, it is good</div></div>',
        '<div class="overlay">{}</div><div class="overlay">Sign up here and now</div>',
        '<div class="post-header-search">{}</div>',
        '<form method=post id="aspnetForm"><div><div>{}</div></div><div><input>Name <select><option>a</select></div></form>',
        '<form method=post><main>{}</main></form><form>Your mail</form>',
        "<div><p>This site uses cookies for a better visit, read our privacy policy and accept.</p></div><div>{}</div>",
        '<div>{}</div><div class="comment-list"><article><p>I liked it very much thank you all for this and '
        "for the rest of what you wrote here and I will be back for more of it.</p></article></div>",
        '<main>{}</main><section hidden>Not seen</section><p style="display: none">Nor this one here</p>',
        '<main>{}</main><div role="alert dialog">Mind the gap please</div>',
    ],
)
def test_articles_are_found_whatever_names_say(page):
    """Names, attributes of other meaning and forms round the page neither hide the article nor save a notice."""
    tree = html_text.grow(html_text.TABLE)
    assert html_text.main_text(f"<body>{MENU}{page.format(ARTICLE)}{LEGAL}</body>", tree) == ARTICLE_TEXT


def test_words_decide_not_names_alone():
    """The same words around them: the tree keeps and drops blocks of one and the same place."""
    tree = html_text.grow(html_text.TABLE)
    verdicts = collections.defaultdict(set)
    links = "".join(f"<li><a href={i}>Part {i}</a>" for i in range(6))
    for page in (
        f"<body>{MENU}<div>{ARTICLE}</div><ul>{links}</ul><p>We use cookies, accept our privacy policy</p></body>",
        f"<body><form>{ARTICLE}<p>Name</p></form></body>",
        f"<body><div class='main-search'>Find it <a href=1>Go</a></div><article>{ARTICLE}<ul>{links}</ul></article></body>",
    ):
        rows = html_text.features(html_text.blocks_of(page))
        for r in rows:
            verdicts[r[0]].add(html_text.decide(tree, r))
    assert verdicts[html_text.OPEN] == verdicts[html_text.ARTICLE] == {True, False}
    assert html_text.DOUBTFUL in verdicts or html_text.OPEN in verdicts


def test_awkward_pages(spark):
    schema = "page_id bigint, url string, html string, text string, id string"
    page = f"<body><article>{ARTICLE}</article></body>"
    pages = [(1, None, page, "x", None), (1, None, page, "x", None), (None, "u", page, None, None), (None, None, None, None, None)]
    got = html_text.extract_main_text(spark.createDataFrame(pages, schema))
    assert got.columns == ["page_id", "url", "id", "text"]
    assert sorted((r["page_id"] or 0, r["text"]) for r in got.collect()) == [(0, ""), (0, ARTICLE_TEXT), (1, ARTICLE_TEXT), (1, ARTICLE_TEXT)]
    assert html_text.extract_main_text(spark.createDataFrame([], schema)).count() == 0


def test_near_duplicates(spark, table, awkward, empty):
    rng = random.Random(5)
    docs = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    base = [f"t{i}" for i in range(120)]
    for i in range(60):
        words = list(base)
        for p in rng.sample(range(120), rng.choice([0, 1, 2, 3, 4, 6])):
            words[p] = f"z{i}"
        docs.append((10_000 + i, " ".join(words)))
    docs += [(20_000, ""), (20_001, None), (20_002, "a b"), (20_003, "A  b"), (20_004, "a b c")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r[0]: r[1:] for r in rows(jaccard.near_duplicates(df))}
    assert got == brute.components(docs)
    assert jaccard.near_duplicates(empty).count() == 0
    assert collections.Counter(r[::2] for r in rows(jaccard.near_duplicates(awkward))) == collections.Counter(
        [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 5), (6, 5), (None, None), (None, None), (7, 4), (8, 8), (9, 9)]
    )
    kept = jaccard.deduplicated(awkward)
    assert kept.columns == awkward.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 8, 9]


def test_chance_meetings_are_not_compared(spark, monkeypatch):
    """Pairs that share a shingle by chance, as many pairs of a large table do, move no texts."""
    phrases = {(i, j): [f"p{i}x{j}x{k}" for k in range(5)] for i in range(30) for j in range(i)}
    docs = [(i, " ".join(w for pair, words in phrases.items() if i in pair for w in [*words, f"u{i}x{pair}"])) for i in range(30)]
    docs += [(100 + i, text + " end") for i, text in docs[:3]]
    compared, verified = [], jaccard.verified
    monkeypatch.setattr(jaccard, "verified", lambda pairs, texts: compared.extend(rows(pairs)) or verified(pairs, texts))
    # A task for each document: its shingles are not known to be common.
    df = spark.createDataFrame(spark.sparkContext.parallelize(docs, len(docs)), "doc_id bigint, text string")
    got = {r[0]: r[1:] for r in rows(jaccard.near_duplicates(df))}
    assert got == brute.components(docs)
    assert sorted(map(tuple, compared)) == [(0, 100), (1, 101), (2, 102)]


def test_near_duplicates_among_equal_prefixes_and_shared_paragraphs(spark, monkeypatch):
    rng = random.Random(9)
    fresh = (f"w{i}" for i in range(100_000))
    take = lambda n: [next(fresh) for _ in range(n)]
    start = take(4)
    p, q = start + take(146), start + take(146)
    q2 = [*q[:70], "other", *q[71:]]
    # Of the three with one beginning and thus one prefix, the first is like neither of the others.
    texts = [base + block for base in [take(60) for _ in range(12)] for block in (p, q, q2)]
    # Unlike documents that share paragraphs, and near copies of some.
    paragraphs = [take(40) for _ in range(12)]
    for _ in range(40):
        text = sum(rng.sample(paragraphs, 6), [])
        texts += [text, [*text[:100], "x", *text[rng.randint(101, 130) :]]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    expected = brute.components(docs)
    assert [expected[i][1] for i in range(3)] == [0, 1, 1]
    assert {r[0]: r[1:] for r in rows(jaccard.near_duplicates(df.coalesce(1)))} == expected
    # None is compared with the most central one, so that links are found among what remains.
    monkeypatch.setattr(jaccard, "_central_pairs", lambda centred, f=jaccard._central_pairs: f(centred).limit(0))
    kept = jaccard._centred
    monkeypatch.setattr(jaccard, "_centred", lambda rows, f=kept: f(rows).unionByName(f(rows).selectExpr("bucket", "centre AS x", "size", "centre").distinct()).withColumn("size", F.lit(3)))
    assert {r[0]: r[1:] for r in rows(jaccard.near_duplicates(df.repartition(5)))} == expected


def test_shuffles_are_freed(spark):
    """Nothing that the steps of a join have shuffled is left when it returns its lazy result."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\d+_\d+_\d+\.data", manager.getAllFiles().mkString(" ")))
    docs = spark.createDataFrame([(i, " ".join(f"w{(i + k) % 97}" for k in range(20))) for i in range(200)], "doc_id bigint, text string")
    before = shuffled()
    jaccard.near_duplicates(docs)
    until = time.time() + 20
    while shuffled() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (901, 901)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_chat(spark):
    said = "<|im_end|>\\<|\\n\n<|im_start|>assistant\\\\ ok"
    nodes = [("t", 1, None, "user", said, None), ("t", 2, 1, "assistant", said, 0.1), ("t", 3, 1, "assistant", None, 0.9),
             ("t", 4, 3, None, "x", 0.9), ("c", 1, 2, "user", "a", None), ("c", 2, 1, "user", "b", None)]
    df = spark.createDataFrame(nodes, "tree_id string, node_id int, parent_id int, role string, text string, score double")
    got = chat.format_trees(df.unionByName(df.limit(1))).withColumn("turns", chat.read_turns(F.col("formatted")))
    by_leaf = {r["leaf_id"]: r for r in got.collect()}
    assert sorted(by_leaf) == [2, 4]  # the cycle has no root
    assert by_leaf[4]["branch"] == 1 and by_leaf[2]["branch"] == 2
    assert [tuple(t) for t in by_leaf[2]["turns"]] == [("user", said), ("assistant", said)]
    assert [tuple(t) for t in by_leaf[4]["turns"]] == [("user", said), ("assistant", ""), ("", "x")]
    assert chat.format_trees(df.limit(0)).count() == 0
    deep = spark.createDataFrame([("d", i, i - 1, "user", "x", None) for i in range(1, 40)], df.schema)
    assert chat.format_trees(deep).first()["n_turns"] == 39


def test_forks_cycles_and_repeated_nodes(spark):
    """Random forests against a walk in Python; results do not depend on the partitioning."""
    rng = random.Random(8)
    nodes = []
    for t in range(12):
        n = rng.randint(1, 40)
        for i in range(n):
            parent = rng.choice([None, -1, *range(i)]) if i else None
            nodes.append((f"t{t}", i, parent, rng.choice(["user", "assistant", None]), f"x{i}", rng.choice([None, 0.1, 0.25, float("nan")])))
        # A cycle with a leaf below it.
        nodes += [(f"t{t}", 100, 101, "user", "c", 1.0), (f"t{t}", 101, 100, "user", "c", 1.0), (f"t{t}", 102, 101, "user", "c", 1.0)]
    # Repeated with other content: the smallest row counts.
    nodes += [("t0", 0, None, "user", "zz", 0.9), ("t0", 0, None, "user", "a", 0.9), ("t1", 0, None, None, None, None)]
    rng.shuffle(nodes)
    least = {}
    for t, i, *row in sorted(nodes, key=lambda r: [(x is not None, str(x)) for x in r]):
        least.setdefault((t, i), row)
    expected = {}
    for t, i in least:
        if any(k[0] == t and r[0] == i for k, r in least.items()):
            continue
        path, at, seen = [], i, set()
        while at is not None and (t, at) in least and at not in seen:
            seen.add(at)
            path.append(at)
            at = least[t, at][0]
        if at in seen:
            continue
        score = sum(round(1e6 * s) for p in path if (s := least[t, p][3]) is not None and s == s) / len(path) / 1e6
        expected[t, i] = (score, [(least[t, p][1] or "", least[t, p][2] or "") for p in reversed(path)])
    schema = "tree_id string, node_id int, parent_id int, role string, text string, score double, formatted int, loss int"
    df = spark.createDataFrame([(*r, 0, 0) for r in nodes], schema)
    results = []
    for parts in (1, 3, 7, 16):
        got = chat.format_trees(df.repartition(parts)).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
        results.append(sorted((r["tree_id"], r["leaf_id"], r["branch"], r["score"], r["formatted"], str(r["loss"])) for r in got))
        assert {(r["tree_id"], r["leaf_id"]): (r["score"], [tuple(t) for t in r["turns"]]) for r in got} == expected
        order = collections.defaultdict(list)
        for r in sorted(got, key=lambda r: r["branch"]):
            order[r["tree_id"]].append((-r["score"], r["leaf_id"]))
        assert all(x == sorted(x) for x in order.values())
        for r in got:
            marked = [r["formatted"][s["start"] : s["start"] + s["length"]] for s in r["loss"]]
            assert marked == [text for role, text in expected[r["tree_id"], r["leaf_id"]][1] if role == "assistant"]
    assert all(r == results[0] for r in results)
    best = chat.format_trees(df, keep_branches=1)
    assert sorted((r["tree_id"], r["leaf_id"]) for r in best.collect()) == sorted(r[:2] for r in results[0] if r[2] == 1)


def test_a_long_conversation_is_written_in_proportion(spark):
    """Nodes are written once for each power of two of their depth, and their ways twice."""
    n = 20_000
    rows = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("t"), "id").alias("text"),
    )
    written = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(chat, "stored", lambda df, name, store=chat.stored: written.append(store(df, name)) or written[-1])
        steps = chat.reply_steps(chat.conversation_nodes(rows))
        assert steps.count() == n
        assert sum(w.count() for w in written) < n * 18
    got = chat.format_trees(chat.conversation_nodes(rows)).first()
    assert got["n_turns"] == n and len(got["loss"]) == n // 2
    assert got["formatted"].startswith("<|im_start|>user\nt0<|im_end|>\n<|im_start|>assistant\nt1<|im_end|>\n")
    last = got["loss"][-1]
    assert got["formatted"][last["start"] : last["start"] + last["length"]] == f"t{n - 1}"


def test_language(spark, sf_dir, awkward, empty):
    got = catalog.QUERIES["op8_language_id"](spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    model = langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    und = {r["doc_id"] for r in langid.identify(awkward, model).where("lang_pred = 'und'").collect()}
    assert und == {1, 2, 3, None}
    assert langid.train(empty) is None
    assert {r["lang_pred"] for r in langid.identify(awkward, None).collect()} == {"und"}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    for n, k in ((1, 2), (7, 3), (300, 4), (1000, 2)):
        scores = rng.normal(0, 2, (n, k)).astype(np.float32)
        begins = np.array([0, n // 3, n // 2])
        best, back = scores[0].astype(float), []
        for i in range(1, n):
            cost = np.where(np.eye(k, dtype=bool) | (i in begins), 0.0, 3.0)
            step = best[:, None] - cost
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + scores[i]
        got = langid.smooth(scores, begins, 3.0)
        value = sum(float(scores[i, s]) for i, s in enumerate(got))
        value -= sum(3.0 for i in range(1, n) if got[i] != got[i - 1] and i not in begins)
        assert abs(value - best.max()) < 1e-2


def test_personal_data(spark, table, awkward, empty):
    luhn = lambda d: sum((int(x) * 2 - 9 * (x > "4")) if i % 2 else int(x) for i, x in enumerate(reversed(d))) % 10 == 0
    kinds = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def base(text):
        out = []
        for kind, pattern in kinds.items():
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m[0])
                good = {"email": True, "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                        "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
                if good:
                    out.append(f"{kind}:{m.start()}:{m.end()}")
        return ",".join(out)

    docs = table("documents")
    got = {r["doc_id"]: r["base_sha256"] for r in pii.pii_digest(pii.pii_spans(docs)).collect()}
    assert got == {r["doc_id"]: brute.sha(base(r["text"])) for r in docs.collect()}
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("a.@1 2-+(5") for _ in range(rng.randint(0, 40)))
        assert base(text) == ",".join(f"{k}:{a}:{b}" for k, a, b, _ in pii.find(text) if k in pii.BASE)
    assert pii.find("IBAN DE89 3704 0044 0532 0130 00")[-1][0] == "iban"
    assert not [s for s in pii.find("IBAN DE88 3704 0044 0532 0130 00") if s[0] == "iban"]
    # Words nearby decide, either way, and are seen in the score.
    kinds_of = lambda text: {k: s for k, _, _, s in pii.find(text)}
    iban, ssn = "DE89 3704 0044 0532 0130 00", "123-45-6789"
    assert kinds_of(f"Pay to {iban} now")["iban"] == 0.6 and kinds_of(f"my bank says {iban}")["iban"] == 0.8
    assert "iban" not in kinds_of(f"a sample is {iban} there") and "iban" in kinds_of(f"a sample account {iban}")
    assert "ssn" not in kinds_of(f"part {ssn} fits") and kinds_of(f"social security {ssn}")["ssn"] == 0.6
    assert "ssn" not in kinds_of(f"order {ssn}, see social " + "x" * pii.REACH)
    assert kinds_of("version 1.2.3.4")["ip"] == 0.3 and kinds_of("server 1.2.3.4")["ip"] == 0.7
    texts = spark.createDataFrame([(1, "version 1.2.3.4 on server 1.2.3.4" + " " * 50 + "at 5.6.7.8")], "doc_id int, text string")
    assert pii.redact_pii(texts, least=0.4).first()["text"].count("<IP>") == 3 - sum(s < 0.4 for *_, s in pii.find(texts.first()["text"]))
    digest = pii.pii_digest(pii.pii_spans(texts)).first()
    assert len(digest["scores"].split(",")) == len(digest["spans"].split(",")) == digest["n_ip"]
    assert pii.pii_spans(empty).count() == pii.redact_pii(empty).count() == 0
    assert pii.redacted("é a@b.cd!", pii.find("é a@b.cd!")) == "é <EMAIL>!"
    assert pii.redact_pii(awkward).count() == 12 and pii.pii_spans(awkward).count() == 12


def test_pieces(spark, table, awkward, empty):
    v = pieces.load_vocabulary()

    def every(segment):
        edges, out = pieces.lattice(v, segment), []

        def walk(at, ids, cost, lengths):
            if at == 0:
                out.append((cost, lengths, ids))
            for k, i, c in edges[at]:
                walk(at - k, [i, *ids], cost + c, (*lengths, -k))

        walk(len(segment), [], 0, ())
        return [(c, i) for c, _, i in sorted(out)]

    rng = random.Random(2)
    for _ in range(100):
        text = "".join(rng.choice(["a", "th", " ", "  ", "\n", "é", "▁", "梦", "ing"]) for _ in range(rng.randint(0, 7)))
        expected = every(text.encode())
        assert pieces.n_best(v, text.encode(), 5) == expected[:5]
        ids, _, costs, _ = pieces._texts(v, pa.array([text]), 4, {})
        assert ids.tolist() == expected[0][1] and costs[0] == [c for c, _ in expected[:4]]
    for docs in (table("documents"), awkward):
        back = pieces.decode(pieces.encode(docs, v), v)
        pick = lambda df: collections.Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
        assert pick(back) == pick(docs)
    assert pieces.encode(empty, v).count() == 0


def test_a_long_word_costs_no_more_memory_than_its_paths():
    """Brute force at small sizes is above; here the best paths stay sound at any length."""
    v = pieces.load_vocabulary()
    word = base64.b64encode(random.Random(1).randbytes(15_000))
    tracemalloc.start()
    found = pieces.n_best(v, word, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60 << 20
    assert [c for c, _ in found] == sorted(c for c, _ in found) and len({tuple(i) for _, i in found}) == 4
    for cost, ids in found:
        assert b"".join(v.pieces[i] for i in ids) == word and cost == sum(int(v.costs[i]) for i in ids)
    # Ties by the thousand: the longer pieces come first from the end.
    same = pieces.n_best(v, b"ab" * 3_000, 3)
    assert b"".join(v.pieces[i] for i in same[0][1]) == b"ab" * 3_000


def test_broadcasts_name_no_class(spark, sf_dir):
    """Workers need no copy of the package."""
    model = langid.train(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    held = []

    class Context:
        def broadcast(self, value):
            held.append(value)
            return spark.sparkContext.broadcast(value)

    class Session:
        sparkContext = Context()

    class Docs:
        sparkSession = Session()

        def __getattr__(self, name):
            return getattr(docs, name)

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    langid.identify(Docs(), model)
    pieces.encode(Docs(), pieces.load_vocabulary())
    assert len(held) == 2 and all(b"candlework" not in pickle.dumps(x) for x in held)


def test_pipeline(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    final = {r["doc_id"]: r for r in corpus_pipeline.run(spark, small).collect()}
    texts = {r["doc_id"]: r for r in docs.collect()}
    stays = {k for k, r in texts.items() if not brute.measures(r["text"])[5]}
    groups = brute.components([(k, texts[k]["text"]) for k in sorted(stays)])
    stays = {k for k in stays if groups[k][1] == k}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    stays -= {r[0] for r in brute.passages([(k, texts[k]["text"]) for k in sorted(stays)], bench) if r[5]}
    # With ten documents of each host, no line reaches the limits there.
    assert set(final) == stays
    v = pieces.load_vocabulary()
    for k in stays:
        text = b"".join(v.pieces[i] for i in final[k]["ids"]).decode()
        assert text == pii.redacted(texts[k]["text"], pii.find(texts[k]["text"]))


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_sharding", "op7_chat_formatting"])
def test_native_queries_have_no_python(spark, small, name):
    plan = catalog.QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
