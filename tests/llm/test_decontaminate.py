import re
from collections import Counter, defaultdict

import pytest

from tillroll.llm import decontaminate as D

WORD = re.compile("[^\x20\x09-\x0d]+")
CONTENT = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]")


def template(text):
    """[(value, template word)] by the rules of the module's docstring, word by word."""
    out, previous_end, opens, after_number, spelled = [], 0, True, False, False
    text = re.sub("([0-9])([A-Za-z])", r"\1 \2", text or "")
    text = re.sub(r"(?i)\b(twenty|thirty|forty|fifty|sixty|seventy|eighty|ninety)-(one|two|three|four|five|six|seven|eight|nine)\b", r"\1 \2", text)
    for m in WORD.finditer(text):
        body = "".join(CONTENT.findall(m[0]))
        if not body:
            continue
        opens = opens or "\n" in text[previous_end : m.start()]
        value = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in body)
        number = bool(re.search("[0-9]", body)) or value in D.NUMBERS
        unit = value in D.UNITS and after_number
        name = bool(re.match("[A-Z][a-z]", body)) and not opens and not number
        if spelled and value in D.NUMBERS:  # a run of number words is one number
            out[-1] = (out[-1][0] + " " + value, "<number>")
            opens, previous_end = m[0][-1] in ".!?:", m.end()
            continue
        spelled = value in D.NUMBERS
        out.append((value, "<number>" if number else "<unit>" if unit else "<name>" if name else value))
        opens = m[0][-1] in ".!?:"
        after_number, previous_end = number, m.end()
    return out


def windows(t, n, literals):
    for i in range(len(t) - n + 1):
        part = t[i : i + n]
        if sum(not x.startswith("<") for _, x in part) >= min(literals, n):
            yield i, tuple(x for _, x in part), [v for v, x in part if x.startswith("<")]


def brute(docs, items, r):
    out = {}
    of_item, holders = {}, defaultdict(set)
    for i, item in items:
        u = template(item)
        if len(u) >= r.min_item_words:
            of_item[i] = list(windows(u, min(r.window, len(u)), r.min_literals))
            for _, w, _ in of_item[i]:
                holders[w].add(frozenset(x for _, x, _ in of_item[i]))
    for d, text in docs:
        t = template(text)
        for i, item in items:
            u = template(item)
            if len(u) < r.min_item_words:
                continue
            n = min(r.window, len(u))
            mine = defaultdict(list)
            for _, w, s in windows(t, n, r.min_literals):
                mine[w].append(s)
            few = [x for x in of_item[i] if len(holders[x[1]]) <= r.max_holders]
            own, common = few or of_item[i], not few
            hit = [(p, s, v) for p, w, s in own for v in mine[w]]
            if not hit:
                continue
            n_matched, slots = len({p for p, _, _ in hit}), defaultdict(Counter)
            for _, s, v in hit:
                for a, b in zip(s, v):
                    slots[a][b] += 1
            total = sum(sum(c.values()) for c in slots.values())
            consistency = sum(max(c.values()) for c in slots.values()) / total if total else 1.0
            if (n_matched / len(own) >= (1 if common else r.min_coverage) or n_matched >= r.min_windows and not common) and consistency >= r.min_consistency:
                out[d, i] = (n_matched, len(own), round(n_matched / len(own), 9), round(consistency, 9))
    return out


def check(docs, items, rules=D.TemplateRules()):
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()], rules)
    got = {(r["doc_id"], r["item_id"]): (r["n_matched"], r["n_windows"], round(r["coverage"], 9), round(r["consistency"], 9)) for r in D.contaminated(docs, items, rules).collect()}
    assert got == want
    return got


ITEMS = [
    (1, "A train leaves Paris at 9 and covers 120 km in 2 hours. How far from Paris is the train after 5 hours?"),
    (2, "What is the capital city of France today?"),
    (3, "too short"),
    (4, None),
    (5, "Give me the sum"),
    (6, "Name some very common words please"),
]
DOCS = [
    (1, "Noise before it. A train leaves London at 7 and covers 90 miles in 3 hours. How far from London is the train after 6 hours? Noise after."),
    (2, "Noise before it. A train leaves London at 7 and covers 90 miles in 7 hours. How far from Madrid is the train after 90 hours? Noise after."),
    (3, "He asked: What is the capital city of Spain today? Nobody knew the answer."),
    (4, "A train leaves the station and covers some distance every day of the week."),
    (5, "please. Name some very common words please now"),
    (6, None),
    (7, ""),
    (8, "Other text, with 3 numbers 4 and 5 km in Rome."),
]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


def test_templates(spark, items):
    got = check(spark.createDataFrame(DOCS, "doc_id bigint, text string"), items)
    assert (1, 1) in got and (2, 1) not in got and (3, 2) in got and (5, 6) in got and {d for d, _ in got} == {1, 3, 5}


def test_equal_brute_force(spark, docs, edge_docs, no_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    got = check(docs, benchmark)
    assert got and check(docs, benchmark, D.TemplateRules(max_sent_windows=0)) == got
    check(edge_docs, benchmark)
    assert D.contaminated(no_docs, benchmark).count() == 0 and D.contaminated(docs, benchmark.limit(0)).count() == 0


def test_stage_keeps_clean_documents(spark, docs, edge_docs):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    gone = {r["doc_id"] for r in D.contaminated(docs, benchmark).collect()}
    kept = D.without_contaminated(docs, benchmark)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - gone
    assert D.without_contaminated(edge_docs, benchmark).count() == edge_docs.count()


def test_each_occurrence_counts_on_its_own(spark, items):
    question = "A train leaves {0} at {1} and covers {2} km in {3} hours. How far from {0} is the train after {4} hours?"
    again = " ".join(question.format(*x) for x in (("Paris", 9, 120, 2, 5), ("London", 7, 90, 3, 6), ("Madrid", 6, 70, 4, 8)))
    chance = DOCS[1][1]
    docs = spark.createDataFrame([(1, again), (2, chance + " " + chance)], "doc_id bigint, text string")
    for rules in (D.TemplateRules(), D.TemplateRules(max_sent_windows=0)):
        got = {(r["doc_id"], r["item_id"]): r for r in D.contaminated(docs, items, rules).collect()}
        assert set(got) == {(1, 1)} and got[1, 1]["coverage"] == 1.0 and got[1, 1]["consistency"] == 1.0


def test_item_that_repeats_a_window(spark):
    text = "please add the number 3 to the number 4 and then please add the number 5 to the number 6 and then"
    df = lambda rows, c: spark.createDataFrame(rows, f"{c} bigint, text string")
    assert D.contaminated(df([(1, text)], "doc_id"), df([(1, text)], "item_id")).count() == 1


def test_items_of_few_literals_match_exactly(spark):
    benchmark = [(1, "What is 12 times 7?"), (2, "Give me the sum"), (3, "Add 3 and 4 and 5 and 6 and 7 and 8 and 9"), (4, "..."), (5, "")]
    rows = [
        (1, "He asked. What is 12 times 7? Then he left."),
        (2, "He asked. What is 13 times 7? Then he left."),
        (3, "Now: give me the sum. Thanks."),
        (4, "Please give me the sum of all these."),
        (5, "So add 3 and 4 and 5 and 6 and 7 and 8 and 9 at once"),
        (6, "So add 4 and 3 and 6 and 5 and 8 and 7 and 1 at once"),
        (7, "give me the sum"),
    ]
    items = spark.createDataFrame(benchmark, "item_id bigint, text string")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for rules in (D.TemplateRules(), D.TemplateRules(max_sent_windows=0)):
        assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, items, rules).collect()} == {(1, 1), (3, 2), (5, 3), (7, 2)}


def test_boilerplate_convicts_nobody(spark):
    """200 items and 200 unrelated documents share an instruction of 20 words: no pair; whole items are still found."""
    order = "Read the question below with care and then write the single best answer in 1 or 2 short words only please"
    item = lambda i: f"{order}: which of the k{i % 7}a rivers runs past the w{chr(97 + i % 26)}x mill at v{chr(97 + i // 26)}y before the bridge?"
    items = spark.createDataFrame([(i, item(i)) for i in range(200)], "item_id bigint, text string")
    rows = [(i, f"{order}: own text number {i} about something else that no benchmark has ever asked anybody at all") for i in range(200)]
    rows += [(1000 + i, f"Before it. {item(i)} After it.") for i in (3, 77)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = check(docs, items)
    assert {d for d, _ in got} == {1003, 1077} and {(1003, 3), (1077, 77)} <= set(got)


def test_items_of_one_template_are_one_holder(spark):
    text = "If a farmer sells {0} eggs at {1} cents each, how many cents does the farmer get in all?"
    items = spark.createDataFrame([(i, text.format(10 + i, 3 + i)) for i in range(30)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "So: " + text.format(99, 98)), (2, "Nothing of the kind in this one at all, really.")], "doc_id bigint, text string")
    assert {d for d, _ in check(docs, items)} == {1}


def test_units_and_number_words_are_typed_whole(spark):
    items = [(1, "A box of 5kg is carried by four men over the long bridge, how heavy is each part?"),
             (2, "There are 12 birds on the old fence and some fly away, how many birds are left?"),
             (3, "The tall tower has thirty-five steps and the guard walks all of them, how long does he need?")]
    rows = [(1, "A box of 7 kg is carried by nine men over the long bridge, how heavy is each part?"),
            (2, "There are twenty-one birds on the old fence and some fly away, how many birds are left?"),
            (3, "The tall tower has 5 steps and the guard walks all of them, how long does he need?"),
            (4, "The tall tower has one hundred twenty steps and the guard walks all of them, how long does he need?")]
    got = check(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 3)}
