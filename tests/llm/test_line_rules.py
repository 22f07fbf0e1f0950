import duckdb

from voicelens.llm import line_rules as L

SCHEMA = "doc_id long, text string, source string, kept string, line int"


def brute_repeat(words, n=8):
    grams = [tuple(words[i:i + n]) for i in range(len(words) - n + 1)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit.update(range(i, i + n))
    return len(hit)


def test_equals_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = sorted(tuple(r) for r in L.line_rules(docs).collect())
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    assert got == sorted(con.execute(L.ORACLE_SQL).fetchall())


def test_edges(spark):
    a, b = "a b c d e f g h", "i j k l m n o p q r s t u v w x y z"
    texts = [None, "", " \n\x0b ", a, f"{a} {a}", f"{a} {b} {a}", f"{b}\n{b}\r\n{b} ", "one two three\nOne  two three", "x " * 5000, f"{b} # $% <| &\x1fq", "word " * 40_000 + b]
    docs = spark.createDataFrame([(i, t, None, "", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in L.line_rules(docs).collect()}
    for i, t in enumerate(texts):
        words = [w for w in "".join(" " if c in L.BLANKS else c for c in t or "").split(" ") if w]
        lines = [x for x in (t or "").split("\n") if x.strip(L.BLANKS)]
        assert got[i].n_words == len(words) and got[i].word_chars == sum(map(len, words))
        assert got[i].n_symbols == sum(c in L.SYMBOLS for c in t or "")
        assert got[i].n_dup_lines == len(lines) - len(set(lines))
        if len(words) < 1000:
            assert got[i].n_repeat_words == brute_repeat(words)
            assert got[i].base_failed == (len(words) < 20 or 100 * brute_repeat(words) > 30 * len(words))
    assert got[8].n_repeat_words == 5000
    assert L.line_rules(docs.limit(0)).count() == 0


def test_boilerplate_is_removed_and_copies_are_not(spark):
    menu = " ".join(f"menu{i}" for i in range(90))
    own = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    rows = [(i, f"{menu.upper() if i % 2 else menu}\n{own(i)}", "h") for i in range(80)]          # 75 % boilerplate
    rows += [(100 + i, f"{own(i)} more\nand {own(i + 500)}", "h") for i in range(40)]
    rows += [(300 + i, f"a copied text {own(7)} end", "h") for i in range(90)]                    # equal texts count once
    rows += [(500, f"{menu}\n{own(900)}", "other")]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA)
    got = {r.doc_id: r for r in L.line_rules(docs).collect()}
    assert all(not got[i].kept and got[i].n_removed_words == 90 for i in range(80))
    assert all(got[i].kept for i in got if i >= 100)
