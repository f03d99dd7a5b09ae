"""Cases that rules over the whole corpus used to lose."""

from graphloom.llm import ocrrepair, spam, truncation


def test_misread_ideograph_with_uses_of_its_own(spark):
    texts = [f"{a}请{b}一下" for a in "若则再并" for b in "求看把先勿" for _ in range(16)]
    wrong = [f"{a}清{b}一下" for a, b in zip("若则再并若", "求看把先勿")]
    right = [f"{a}清理一下" for a in "若则再并" for _ in range(40)]
    rows = [(i, "d", "p", f"f{i % 7}", i, "description", t) for i, t in enumerate(["Title", *texts, *wrong, *right])]
    lines = spark.createDataFrame(rows, "line_id long, document_id string, src string, file_name string, line_no int, section string, text string")
    first = 1 + len(texts)
    assert {r.line_id for r in ocrrepair.found(lines).where("fault = 'misread'").collect()} == set(range(first, first + len(wrong)))


def test_spam_does_not_raise_its_own_threshold(spark):
    honest = [f"The caller must open handle {i} before it uses the queue. If the queue is empty, the call returns at once. " * 4 for i in range(40)]
    copies = ["If you need the Widget driver, keep the Widget driver. " * 10] * 20
    others = [f"If you need the Cable{i} modem, keep the Cable{i} modem. " * 10 for i in range(8)]
    weaker = ["The Widget driver is here and not there. The Widget driver is the Widget driver. " * 10]
    pages = [*honest, *copies, *others, *weaker]
    docs = spark.createDataFrame(list(enumerate(pages)), "doc_id long, text string")
    assert {r.doc_id for r in spam.found(docs).collect()} == set(range(len(honest), len(pages)))


def test_copies_of_a_cut_text_prove_nothing(spark):
    tails = ["queue", "cache", "buffer", "device"]
    whole = [f"Driver {a} opens the handle and handles a damage of the {b}." for a in ["alpha", "beta", "gamma", "delta", "omega"] for b in tails]
    cut = ["Driver zeta opens the handle and handles a damage"] * 20 + ["Driver kappa opens the handle and handles a damage..."]
    rows = [(i, "f", "t", t, None) for i, t in enumerate([*whole, *cut])]
    entities = spark.createDataFrame(rows, "rec_id long, feed string, src string, description string, remarks string")
    assert {r.rec_id for r in truncation.found(entities).collect()} == set(range(len(whole), len(rows)))


def test_thresholds_follow_the_language(spark):
    """A list is spam where texts are sentences, and none where the language's own texts are half lists: thresholds move."""
    prose = lambda i: f"The caller must open handle {i} before it uses the queue number {i}. If it is empty, the call returns. " * 2
    tags = lambda i, n: "\n".join(f"Widget{i + k} cheap" for k in range(n))
    plain, mixed = [prose(i) for i in range(70)], [prose(i) + "\n" + tags(i, 12) for i in range(70)]
    page = prose(900) + "\n" + tags(900, 60)
    at = {}
    for name, texts in (("plain", plain), ("mixed", mixed), ("few", plain[:10])):
        docs = spark.createDataFrame(list(enumerate([*texts, page])), "doc_id long, text string")
        scores = {r.doc_id: r for r in spam.scored(docs).collect()}
        at[name] = scores[len(texts)]
    assert at["plain"].at_listed == 0.5 and at["mixed"].at_listed > 0.65 and at["few"].at_listed == spam.FLOORS["listed"]
    assert at["mixed"].at_separators > at["plain"].at_separators and at["mixed"].at_prose < at["plain"].at_prose


def test_short_spam_and_short_texts(spark):
    pages = [("red | blue | green | pink | grey | brown | white", True), ("#Tag1 #Tag2 #Tag3 #Tag4 #Tag5, #Tag6", True), ("http://a.b\nhttp://a.c\nhttp://a.d\nhttp://a.e\nhttp://a.f", True), ("OpenIt", False), ("0", False), ("Open it, then close it.", False), ("a, b", False)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(pages)], "doc_id long, text string")
    assert {r.doc_id for r in spam.found(docs).collect()} == {i for i, (_, bad) in enumerate(pages) if bad}


LINE = "line_id long, document_id string, src string, file_name string, line_no int, section string, text string"


def test_paragraphs_are_repaired_by_place(spark):
    """Only the misread places change; a compound keeps its hyphen; a word misread on both its lines is a case on both."""
    common = ["若缓存为空则返回错误。", "读取缓存的结果并写入缓存。", "The caller must flush the internal cache in user-mode code at once.", "A multiple of pages is still released by the scheduler.", "Tell the softbench and the caller."] * 30
    text = ["Title of it", "Tell tbe softbench and tbe caller.", "The callcr must flush the intcr-", "nal cachc in user-", "mode code. A muItiple of pages is stiIl releascd.", "// the callcr"]
    rows = [(i, "d", "p", f"f{i % 9}", i, "description", t) for i, t in enumerate(["Other title", *common])] + [(1000 + i, "d", "p", "last", i, "description", t) for i, t in enumerate(text)]
    lines = spark.createDataFrame(rows, LINE)
    got = " ".join(r.text for r in ocrrepair.paragraphs(lines).where("file_name = 'last'").collect())
    assert "Tell the softbench and the caller." in got
    assert "The caller must flush the internal cache in user-mode code. A multiple of pages is still released." in got
    bad = {r.line_id for r in ocrrepair.found(lines).where("fault = 'misread'").collect()}
    assert {1002, 1003, 1004, 1005} <= bad and not any(i < 1000 for i in bad)


def test_parts_and_places():
    assert ocrrepair._differs("intcrnal", "internal", 5) == (True, False) and ocrrepair._differs("intcrnal", "internal", 3) == (False, True)
    assert ocrrepair._differs("cachcdc", "cachede", 5) == (True, True)
    found = [("mi", 0), ("Iliseconds", 2), ("x", 13)]
    assert ocrrepair.merges(found) == [{"at": 0, "seen": "miIliseconds", "meant": "milliseconds"}]
    assert ocrrepair.merges([("fa", 0), ("I", 2), ("Is", 3)])[0]["meant"] == "falls" and ocrrepair.merges([("Size", 0), ("Info", 5)]) == []


def test_confusions_are_estimated(spark):
    """Where the corpus misreads e as c alone, that pair gains and its rivals lose; without errors all keep their start."""
    words = [(w, 400) for w in ("the", "caller", "cache", "release", "header")] + [(w, 9) for w in ("thc", "callcr", "cachc", "rclease", "hcader")]
    counts = spark.createDataFrame(words, "word string, n long")
    got = ocrrepair.estimated(ocrrepair._latin(counts))
    assert got["e", "c"] > ocrrepair.CONFUSIONS["e", "c"] and got["m", "rn"] == ocrrepair.CONFUSIONS["m", "rn"]
    assert ocrrepair.estimated(ocrrepair._latin(counts.limit(0))) == ocrrepair.CONFUSIONS
    assert ocrrepair.undone("tbc")["the"][1] == ("e c", "h b") or ocrrepair.undone("tbc")["the"][1] == ("h b", "e c")


def test_page_numbers_go_on_by_the_length_of_pages(spark):
    texts = ["Widget Queue Reference"]
    for page in range(1, 12):
        texts += ["The caller must flush the cache."] * 25 + ([str(page), "Widget Queue Reference"] if page not in (4, 5, 6) else [str(page)] if page == 6 else []) + (["A line.", "64", "A line."] if page == 8 else [])
    lines = spark.createDataFrame([(i, "d", "p", "f", i, "description", t) for i, t in enumerate(texts)], LINE)
    got = {r.line_id for r in ocrrepair.furniture(lines).where("fault = 'page_number'").collect()}
    assert {texts[i] for i in got} == {"1", "2", "3", "6", "7", "8", "9", "10", "11"} and len(got) == 9
