import random
import re

import pytest
from fixtures import SF, documents, prose

from tidegate.llm import decontamination as dc
from tidegate.llm.common import table

QUESTION = "A train leaves Utrecht at 9 and travels 120 km before it meets another train that left Zwolle 45 minutes later, how fast was the second train?"
CHANGED = "A train leaves Arnhem at 7 and travels 310 miles before it meets another train that left Gouda 20 hours later, how fast was the second train?"
INCONSISTENT = "First Anna gave 5 apples to Bert and then Anna gave 5 pears to Carl while Bert kept 3 plums for the whole long week"
BROKEN = "First Emma gave 6 apples to Finn and then Gina gave 8 pears to Hugo while Ivan kept 9 plums for the whole long week"
KEPT = "First Emma gave 6 apples to Finn and then Emma gave 6 pears to Hugo while Finn kept 9 plums for the whole long week"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_changed_numbers_names_and_units_are_found(spark):
    bench = items(spark, [(1, QUESTION), (2, INCONSISTENT)])
    rows = [(1, prose(1, 50) + ". " + QUESTION), (2, "So. " + CHANGED.upper()[:1] + CHANGED[1:] + " " + prose(2, 50)), (3, prose(3, 200)),
            (4, "We know. " + BROKEN), (5, "We know. " + KEPT), (6, QUESTION.replace("travels", "rolls").replace("left", "quit").replace("fast", "slow"))]
    got = {(r.doc_id, r.item_id): (r.changed, r.consistent) for r in dc.matches(documents(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (5, 2)}
    assert got[(1, 1)][0] == 0 and got[(2, 1)][0] >= 5
    kept = dc.clean_documents(documents(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 6]


def test_planted_passages_of_the_table_are_found_and_others_left(spark):
    sf = SF.replace("0.001", "0.01")
    docs, bench = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    texts = [(r.item_id, plain(r.text)) for r in bench.collect()]
    whole, touched = set(), set()
    for r in docs.select("doc_id", "text").collect():
        text = plain(r.text or "")
        for item, t in texts:
            if t in text:
                whole.add((r.doc_id, item))
            words = t.split()
            if any(" ".join(words[i : i + 8]) in text for i in range(0, max(1, len(words) - 7))):
                touched.add((r.doc_id, item))
    got = {(r.doc_id, r.item_id) for r in dc.matches(docs, bench).collect()}
    assert whole and whole <= got <= touched


def test_template_kinds():
    kinds, values, letters, counts = dc.templates(["It costs 5 km. Then Bob ran 3,000 mm to Rome ... Then he ! Sat", "", "7 %"], dc._Tokens())
    assert kinds.tolist() == [0, 0, 1, 3, 0, 2, 0, 1, 3, 0, 2, 0, 0, 0, 1, 3]
    assert counts.tolist() == [14, 0, 2]


@pytest.mark.parametrize("limit", [0, 10**9])
def test_tokens_may_be_forgotten(limit, monkeypatch):
    monkeypatch.setattr(dc, "KNOWN", limit)
    tokens = dc._Tokens()
    one = dc.templates(["a B 3 kg"], tokens)
    two = dc.templates(["a B 3 kg"], tokens)
    assert [x.tolist() for x in one] == [x.tolist() for x in two]


def test_odd_rows(spark):
    bench = items(spark, [(1, None), (2, ""), (3, "one two three four five six seven eight nine ten"), (4, "1 2 3 4 5 6 7 8 9 10"),
                          (5, "short item here"), (3, "one two three four five six seven eight nine ten"), (None, "alpha beta gamma delta epsilon zeta eta theta iota")])
    ten = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, "SHORT item, here"), (4, "4 5 6 7 8 9 10 11 12 13"), (None, ten), (6, ten), (6, ten), (6, "other text"),
            (7, "say short item here now"), (8, "alpha beta gamma delta epsilon zeta eta theta iota"), (9, "word " * 50_000 + ten)]
    docs = documents(spark, rows).selectExpr("*", "1 as hash", "2 as item_id", "'r' as row", "0 as windows")
    got = {(r.doc_id, r.item_id) for r in dc.matches(docs, bench.selectExpr("*", "1 as hash", "2 as kinds")).collect()}
    assert got == {(3, 5), (None, 3), (6, 3), (7, 5), (8, None), (9, 3)}
    left = dc.clean_documents(docs, bench)
    assert left.columns == docs.columns
    assert {(r.doc_id, r.text) for r in left.collect()} == {
        (1, None), (2, ""), (4, "4 5 6 7 8 9 10 11 12 13"), (6, "other text")
    }


APPLES = "On the market Anna sold 12 apples and 5 pears to the old baker who paid her with a loaf of fresh bread"


@pytest.mark.parametrize("change", [
    lambda t: t.replace("Anna", "Anna Maria"), lambda t: t.replace("12", "twelve").replace("5", "five"), lambda t: t.replace("12", "thirty two").replace("5", "21"),
    lambda t: t.replace("old baker", "very old baker"), lambda t: t.replace("the old baker", "the baker"), lambda t: t.replace("Anna", "Jan Willem van Dam"),
])
def test_longer_names_number_words_and_a_word_more_or_less(spark, change):
    bench = items(spark, [(1, APPLES), (2, QUESTION)])
    rows = [(1, prose(1, 60) + ". " + change(APPLES) + " " + prose(2, 60)), (2, prose(3, 100))]
    assert {(r.doc_id, r.item_id) for r in dc.matches(documents(spark, rows), bench).collect()} == {(1, 1)}


def test_items_without_ordinary_words_or_blanks_and_short_ones(spark):
    series, chinese = "3 1 4 1 5 9 2 6 5 3 5 8", "水在标准大气压下的沸点是多少摄氏度"
    bench = items(spark, [(1, series), (2, chinese), (3, "What is the boiling point?"), (4, "2 + 2 = ?"), (5, "Yes"), (6, "7 km")])
    rows = [(1, series), (2, "the digits " + series + " go on"), (3, chinese), (4, "问：" + chinese + "？答：一百"), (5, "He asked: what is the boiling point? Nobody knew."),
            (6, "2 2 and 7 km and 9 km yes"), (7, "3 1 4 1 5 9 2 7 5 3 5 8"), (8, "what is the melting point of the boiling one"), (9, "水在山上")]
    got = {(r.doc_id, r.item_id) for r in dc.matches(documents(spark, rows), bench).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3)}


def plain_matches(docs, bench, size=dc.WINDOW):
    """The same by plain loops over every document and item."""
    tokens, out = dc._Tokens(), set()

    def cut(text):
        found = {}
        slots, plain = dc.streams([text], tokens)
        for stream, template in ((slots, True), (plain, False)):
            n = int(stream.counts[0])
            for own in range(1, size + 1):
                for w in range(n - own + 1):
                    tells = sum(k == 0 for k in stream.kinds[w : w + own]) >= dc.ORDINARY
                    if tells == template and (template or own >= size or sum(stream.letters[w : w + own]) >= dc.LETTERS):
                        found.setdefault((own, template, tuple(stream.words[w : w + own].tolist())), []).append(
                            (int(stream.start[w]), int(stream.end[w + own - 1]), [(int(k), int(v)) for k, v in zip(stream.kinds[w : w + own], stream.values[w : w + own])] if template else [])
                        )
        return found, {True: int(slots.counts[0]), False: int(plain.counts[0])}

    items_ = [(i, *cut(t)) for i, t in bench if t]
    for doc_id, text in docs:
        own = cut(text)[0] if text else {}
        for item, found, counts in items_:
            mine = {k: v for k, v in found.items() if k[0] == size or k[0] == counts[k[1]]}
            places = {(s, k[1]) for k, v in mine.items() for s, _, _ in v}
            words = max((e for v in mine.values() for _, e, _ in v), default=0)
            hits = [(k[1], i, d) for k, v in mine.items() for i in v for d in own.get(k, [])]
            for offset in (0, dc.DRIFT // 2):
                for band in {(d[0] - i[0] + offset) // dc.DRIFT for _, i, d in hits}:
                    some = [(t, i, d) for t, i, d in hits if (d[0] - i[0] + offset) // dc.DRIFT == band]
                    pairs = {(a[1], b[1]) for _, i, d in some for a, b in zip(i[2], d[2]) if a[0]}
                    consistent = len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
                    matched = len({(i[0], t) for t, i, _ in some})
                    covered = len({w for _, i, _ in some for w in range(i[0], i[1])})
                    if consistent and (matched >= dc.COVERAGE * len(places) or covered >= dc.WORDS_COVERED * words):
                        out.add((doc_id, item))
    return out


def test_agrees_with_plain_loops(spark):
    rng = random.Random(12)
    bench = [(i, " ".join(rng.choice(["the", "river", "stone", "Anna", "Bert", "7", "12", "km", "quiet", "green", "five"]) for _ in range(rng.randrange(1, 22)))) for i in range(25)]
    docs = []
    for i in range(60):
        words = (prose(i, rng.randrange(0, 20)) + " " + rng.choice(bench)[1] + " " + prose(i + 99, rng.randrange(0, 20))).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = rng.choice(["9", "Carl", "stone", "very old", "miles"])
        docs.append((i, " ".join(words)))
    got = {(r.doc_id, r.item_id) for r in dc.matches(documents(spark, docs), items(spark, bench)).collect()}
    want = plain_matches(docs, bench)
    assert got == want and len(want) > 30


def test_agrees_with_plain_loops_on_the_smallest_table(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    got = {(r.doc_id, r.item_id) for r in dc.matches(docs, bench).collect()}
    assert got and got == plain_matches([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, QUESTION)]), items(spark, [(1, QUESTION)])
    assert dc.matches(docs.where("doc_id < 0"), bench).count() == 0
    assert dc.matches(docs, bench.where("item_id < 0")).count() == 0
    assert dc.clean_documents(docs, bench.where("item_id < 0")).count() == 1
    assert dc.clean_documents(docs.where("doc_id < 0"), bench).count() == 0
