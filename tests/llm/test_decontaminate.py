from fareflow.llm import decontaminate

MEDIUM = "/root/testdata/sf0.01"
ITEMS = [(1, "If the shop of Alice sells 3 apples at 4.50 dollars each, how much money does Alice make for 3 apples in one day?"),
         (2, "two words"), (3, None), (4, ""), (5, "a plain question that has no number and no name in it at all, not even a date")]
SCHEMA = "doc_id long, text string"


def found(spark, docs, **how):
    out = decontaminate.matches(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(ITEMS, "item_id long, text string"), **how)
    return {(r.doc_id, r.item_id): r for r in out.collect()}


def test_reparameterised_questions(spark):
    out = found(spark, [
        (1, "Well: if the shop of Alice sells 3 apples at 4.50 dollars each, how much money does Alice make for 3 apples in one day?"),
        (2, "IF the shop of Carol sells 7 apples at 12,99 dollars each - how much money does Carol make for 7 apples in one day?"),
        (3, "if the shop of Carol sells 7 apples at 12,99 dollars each, how much money does Dave make for 9 apples in one day?"),
        (4, "A plain question, that has no number AND no name in it at all, not even a date; and more"),
        (5, "a plain question that has no number but is otherwise about something else, and goes on"),
        (6, None), (7, ""), (8, "two words"), (None, ITEMS[4][1]), (9, "x " * 100_000 + ITEMS[4][1])])
    assert set(out) == {(1, 1), (2, 1), (4, 5), (9, 5)}
    assert not out[1, 1].reparameterised and out[2, 1].reparameterised and out[2, 1].n_slots == 6
    assert out[4, 5].n_matched == out[4, 5].n_windows and out[4, 5].n_slots == 0


def test_items_in_documents(spark):
    docs, items = (spark.read.parquet(f"{MEDIUM}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, wanted = docs.collect(), items.collect()
    verbatim = {(d.doc_id, i.item_id) for d in texts for i in wanted if i.text in d.text}
    out = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    assert verbatim and out == verbatim
    kept = decontaminate.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({d for d, _ in verbatim})


def test_rows_without_id_empty_tables_and_other_columns(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame([(None, ITEMS[4][1], 1, "a"), (1, ITEMS[4][1], 2, "b"), (1, "other", 3, "c")],
                                 "doc_id long, text string, item_id long, words string")
    assert [r.words for r in decontaminate.drop_contaminated(docs, items).collect()] == ["a"]
    assert decontaminate.matches(docs.limit(0), items).count() == 0
    assert decontaminate.matches(docs, items.limit(0)).count() == 0


def test_alignments_are_judged_by_themselves(spark):
    periodic = "say Tom has 3 apples, Anna has 5 apples, Bob has 7 apples, Kim has 9 apples, Joe has 4 apples, who has most of all the apples"
    digits = "now add up 1 2 3 4 5 6 7 8 9 10 11 12 and say what the sum of all of them is"
    shop = ITEMS[0][1]
    other = shop.replace("Alice", "Carol").replace("3", "7").replace("4.50", "12")
    items = spark.createDataFrame([(1, periodic), (2, digits), (3, shop)], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"x {periodic}"), (2, digits), (3, f"{shop} And once more: {other}"), (4, f"{other} and {shop.replace('Alice', 'Dave')}"),
         (5, "so " + other.replace("Carol make", "Dave make"))], SCHEMA)
    out = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()}
    assert out == {(1, 1), (2, 2), (3, 3), (4, 3)}


def test_names_at_every_place(spark):
    item = ("Alice sells apples to all of her friends in town. Alice buys pears from an old farmer every single week. "
            "Alice keeps what is left over for her own kitchen. How much does she spend?")
    other = item.replace("Alice", "Robert")
    docs = [(1, item), (2, other), (3, item.replace(". ", ".\n\n")), (4, item.lower()), (5, item.upper()), (6, other.replace(" Robert", ' "Robert')),
            (7, "we know that " + item.replace(" ", "  ")), (8, item.replace("Alice buys", "Robert buys").replace("Alice keeps", "Henry keeps"))]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r.doc_id: r for r in decontaminate.matches(spark.createDataFrame(docs, SCHEMA), items).collect()}
    assert set(out) >= {1, 2, 3, 4, 5, 6, 7}
    assert out[2].n_matched == out[2].n_windows == out[4].n_matched and out[2].reparameterised and not out[4].reparameterised


def test_short_items_are_found_word_by_word(spark):
    items = spark.createDataFrame([(1, "What is 12 times 7 plus 5?"), (2, "two words"), (3, "who is Ann and why?"), (4, ITEMS[4][1])], "item_id long, text string")
    docs = [(1, "So: what is 12 times 7, plus 5? And more."), (2, "what is 13 times 7 plus 5"), (3, "two words"), (4, "x. Who is ann, and why"), (5, None), (6, ITEMS[4][1])]
    out = {(r.doc_id, r.item_id): r for r in decontaminate.matches(spark.createDataFrame(docs, SCHEMA), items).collect()}
    assert set(out) == {(1, 1), (4, 3), (6, 4)} and out[1, 1].n_slots == 3 and not out[1, 1].reparameterised


def plain_windows(words, window):
    """Every window of a text under each reading, by the marks its words carry."""
    def read(word, names):
        mark = word[0] if decontaminate.NUMBER <= word[0] < decontaminate.AFTER else ""
        if mark in (decontaminate.NUMBER, decontaminate.UNIT):
            return mark
        return decontaminate.NAME if mark and mark in names else word.strip(decontaminate.NAMES)
    return {tuple(read(w, names) for w in words[i:i + window]) for names in decontaminate.READINGS for i in range(len(words) - window + 1)}


def test_windows_against_a_plain_template_matcher(spark, rows):
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows[:120]] + [(1000 + i, t) for i, t in ITEMS if t], SCHEMA)
    benchmark = spark.read.parquet(f"{MEDIUM}/benchmark.parquet").select("item_id", "text").unionByName(
        spark.createDataFrame(ITEMS, "item_id long, text string"))
    words = {r.doc_id: r.w for r in docs.select("doc_id", decontaminate.template_words(docs["text"]).alias("w")).collect()}
    wanted = [(r.item_id, r.w) for r in benchmark.select("item_id", decontaminate.template_words(benchmark["text"]).alias("w")).collect()]
    of_items = {}
    for item, w in wanted:
        for window in plain_windows(w or [], 8):
            of_items.setdefault(window, set()).add(item)
    enough = set()
    for doc, w in words.items():
        met = {}
        for window in plain_windows(w or [], 8) & set(of_items):
            for item in of_items[window]:
                met[item] = met.get(item, 0) + 1
        enough |= {(doc, i) for i, n in met.items()}
    out = {(r.doc_id, r.item_id) for r in decontaminate.matches(docs, benchmark, run=1, share=0.0).filter("n_windows > 1").collect()}
    assert out <= enough and {d for d, _ in out} >= {1001, 1005}
