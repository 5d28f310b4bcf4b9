import json
import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import glossary as G
from docweave.operators import renames as RN
from docweave.operators import structure as ST
from docweave.operators import term_match as TM
from docweave.operators.flow import process_documents
from docweave.operators.requests import offline_replies
from docweave.operators.validation import glossary_violations
from docweave.sinks.report import report_pieces, write_report_documents
from docweave.sources.config import TEST_GLOSSARY, TEST_LANGUAGES, Glossary

# many terms ------------------------------------------------------------------

TEXTS = ["", None, "abcabc", "the cat sat", "日本語のテキスト", "xéy", "a" * 5000, "The Cat", "über straße", "\n tab\t"]
TERMS = ["abc", "bca", "cat", "the cat", "at", "a", "aaaa", "aaaaa", "本語", "é", "straße", "", None, "cat", "zzz", "Cat", "\n", "bcab", "abcabcd"]


@pytest.mark.parametrize("limit", [None, 0])
def test_terms_by_contains(spark, limit):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcé ") for _ in range(rng.randrange(60))) for _ in range(40)]
    terms = TERMS + ["".join(rng.choice("abcé ") for _ in range(rng.randrange(1, 7))) for _ in range(60)]
    rows = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, n int").repartition(3)
    got = TM.match_terms(rows, ["id"], spark.createDataFrame([(t,) for t in terms], "term string"), automaton_chars=limit)
    assert got.columns == ["id", "text", "n", "found"]
    want = {i: sorted({w for w in terms if w is not None and w in t} if t is not None else []) for i, t in enumerate(texts)}
    assert {r.id: r.found for r in got.collect()} == want


def test_terms_of_nothing(spark):
    rows = spark.createDataFrame([(1, "text")], "id int, text string")
    for limit in (None, 0):
        assert [r.found for r in TM.match_terms(rows, ["id"], spark.createDataFrame([], "term string"), automaton_chars=limit).collect()] == [[]]
        assert TM.match_terms(rows.limit(0), ["id"], spark.createDataFrame([("x",)], "term string"), automaton_chars=limit).count() == 0


def test_a_large_glossary_plans_at_once(spark):
    glossary = spark.range(100_000).select(F.concat(F.lit("term"), "id").alias("term"), F.explode(F.array(F.lit("en"), F.lit("es"))).alias("lang"),
                                           F.concat(F.lit("x"), "id").alias("rendering"), F.col("id").cast("int").alias("ord"))
    parts = spark.createDataFrame([(1, "see term99999 and term12 here"), (2, "nothing")], "doc int, text string")
    got = sorted((r.doc, r.term, r.lang) for r in TM.glossary_hits(parts, ["doc"], glossary).collect())
    terms = ["term1", "term12", "term9", "term99", "term999", "term9999", "term99999"]
    assert got == [(1, t, lang) for t in terms for lang in ("en", "es")]


def test_violations_equal_those_of_a_literal_glossary(spark):
    g = Glossary.from_mapping({"Hund": {"en": "dog", "es": "perro"}, "kat": {"en": "cat"}, "leer": {"en": ""}})
    pairs = spark.createDataFrame([(1, "en", "der HUND", "the Dog"), (2, "en", "Hund und KATZE", "nothing"), (3, "es", "Hund leer", "gato"),
                                   (4, "fr", "Hund", "chien"), (5, "en", "leer", "x")], "id int, lang string, original string, translated string")
    want = {r.id: r.terms for r in glossary_violations(pairs, g).collect() if r.terms}
    got = {}
    for r in TM.glossary_violations(pairs, ["id"], g.df(spark)).orderBy("term").collect():
        got[r.id] = ",".join(filter(None, [got.get(r.id), r.term]))
    assert got == want == {2: "Hund,kat", 3: "Hund"}


# earlier terms with failed parts -----------------------------------------------

def test_failed_parts_count_for_none(spark):
    g = Glossary.from_mapping({"alpha": {"en": "A", "es": "A"}, "beta": {"en": "B", "es": "B"}})
    parts = spark.createDataFrame([(1, 1, "alpha"), (1, 2, "beta alpha"), (1, 3, "x"), (2, 1, "beta")], "doc int, part_no int, text string")
    failed = spark.createDataFrame([(1, 1, "es"), (1, 2, "en")], "doc int, part_no int, lang string")
    got = {(r.doc, r.part_no, r.lang): r.earlier for r in G.earlier_terms(parts, ["doc"], g, failed=failed, targets=("en", "es")).collect()}
    assert got == {(1, 1, "en"): [], (1, 2, "en"): ["alpha"], (1, 3, "en"): ["alpha"], (2, 1, "en"): [],
                   (1, 1, "es"): [], (1, 2, "es"): [], (1, 3, "es"): ["alpha", "beta"], (2, 1, "es"): []}


def test_parts_after_failed_ones_are_sent_again(spark):
    # part texts are cut at headers; a part whose length is a multiple of 17 fails
    md = "# one\n" + "the " * 7 + "\n# two\n" + "x" * 30 + "\n# three\n" + "y" * 31
    docs = spark.createDataFrame([("a.md", md)], "rel_path string, md string")
    prompts = []

    def seen(requests, fn):
        rows = requests.collect()
        prompts.append({r.part_no: r.system_prompt for r in rows if r.kind == "body"})
        from docweave.operators.requests import run_requests
        return run_requests(requests, fn)
    for refine in (False, True):
        process_documents(docs, spark, ["en"], TEST_LANGUAGES, TEST_GLOSSARY, offline_replies, 10, call=seen, refine=refine).collect()
    first, again = prompts[1], prompts[2]
    assert prompts[0] == first and len(first) == 3
    assert len("# one\n" + "the " * 7) == 34 and all(G.EARLIER_TERMS_HEADING in first[k] for k in (2, 3))
    assert set(again) == {2, 3} and not any(G.EARLIER_TERMS_HEADING in p for p in again.values())


# block sequences ----------------------------------------------------------------

@pytest.mark.parametrize(("text", "codes"), [
    ("", ""), ("\n\n \n", ""), ("para\nstill\n\nnew", "pp"), ("# a\n## b\n###### c\n#no\n####### x", "126p"),
    ("```py\n# a\n\n- b\n```\nafter", "fp"), ("  ```\nopen\n# x", "f"), ("```", "f"), ("a\n```\n```\n```\nb", "pff"),
    ("| a | b |\n|---|---|\n| 1 | 2 |\n\n| x |", "tt"), ("- a\n* b\n+ c\n1. d\n12) e\n-no", "lllllp"), ("import x\n:::note\n:::\n<Tag a/>\n</details>", "iaaxx"),
    ("p\n# h\np", "p1p"), ("\ue001\ue005text", "p"), ("t\t\n \t\nu", "pp"), ("a\x0bb\x85c d\ne", "p")])
def test_block_codes(spark, text, codes):
    assert spark.createDataFrame([(text,)], "t string").select(ST.block_codes("t")).first()[0] == codes


def edits(a, b):
    """Least insertions and deletions, by the textbook table."""
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(row[j - 1] if c == d else 1 + min(row[j], new[-1]))
        row = new
    return row[-1]


def test_scripts_are_shortest():
    rng = random.Random(6)
    cases = [("", ""), ("a", ""), ("", "b"), ("abc", "abc"), ("abcabba", "cbabac"), ("p" * 40, "p" * 39 + "l"), ("lp", "pl")]
    for _ in range(600):
        a = "".join(rng.choice("plf") for _ in range(rng.randrange(14)))
        b = "".join(rng.choice("plf") for _ in range(rng.randrange(14))) if rng.random() < 0.5 else a[:rng.randrange(len(a) + 1)] + rng.choice("plf") + a[rng.randrange(len(a) + 1):]
        cases.append((a, b))
    for a, b in cases:
        script = list(ST.edit_script(a, b))
        assert "".join(s for op, s in script if op != "+") == a and "".join(s for op, s in script if op != "-") == b
        assert sum(len(s) for op, s in script if op != "=") == edits(a, b), (a, b, script)
    assert ST.script_text("1ppl", "1pll2") in ("=2 -p +l =1 +2", "=2 -pl +ll2", "=2 -p =1 +l2", "=2 +l -p =1 +2")
    long = "1pplf" * 4000
    assert sum(len(s) for op, s in ST.edit_script(long, long[:9000] + "2" + long[9003:]) if op != "=") == 4


def test_scripts_of_pairs(spark):
    pairs = spark.createDataFrame([(1, "# a\n\ntext", "# a\n\ntext"), (2, "# a\n\ntext", "## a\n\ntext\n\nmore"), (3, None, "x")], "id int, original string, translated string")
    assert {r.id: r.script for r in ST.structure_scripts(pairs).collect()} == {2: "+2p -1 =1", 3: "+p"}
    got = {r.id: tuple(r)[1:] for r in ST.structure_diff(pairs.where("id < 3")).collect()}
    assert got == {1: (2, 2, None, None, None, 0), 2: (2, 3, 0, "1", "2", 2)}


# renames --------------------------------------------------------------------------

def by_hand(deleted, added, share):
    import re

    def cut(t):
        return {c for c in re.split("(?<=\x00)", re.sub(r"([^ \n\t]{9,}[ \t]+|\n)", "\\1\x00", t)) for c in [c.replace("\x00", "")] if c.strip(" ")}
    out, old, new = {}, {p: t for p, t in deleted if t is not None}, {p: t for p, t in added if t is not None}
    for p in sorted(old):
        same = sorted(q for q in new if new[q] == old[p])
        if same:
            out[p] = (same[0], 1.0)
            del new[same[0]]
    old = {p: cut(t) for p, t in old.items() if p not in out}
    new = {p: cut(t) for p, t in new.items()}
    weight = lambda s: sum(map(len, s))
    pairs = sorted((-weight(a & b) / max(weight(a), weight(b)), p, q) for p, a in old.items() for q, b in new.items() if a & b)
    for s, p, q in pairs:
        if -s >= share and p not in out and q not in {x for x, _ in out.values()}:
            out[p] = (q, -s)
    return out


def test_renames_by_hand(spark):
    rng = random.Random(11)
    words = [f"{'long' * rng.randrange(4)}{i}" for i in range(60)]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 60))).replace("7 ", "7\n") for _ in range(14)]
    deleted = [(f"old/{i}", t) for i, t in enumerate(docs)] + [("old/a", "same"), ("old/b", "same"), ("old/n", None), ("old/e", "")]
    added = []
    for i, t in enumerate(docs):
        w = t.split(" ")
        for _ in range(i // 2):
            w[rng.randrange(len(w))] = rng.choice(words)
        added.append((f"new/{rng.randrange(100)}/{i}", " ".join(w)))
    added += [("new/copy", docs[2]), ("new/x", "same"), ("new/n", None), ("new/e", ""), ("new/other", "nothing like it")]
    schema = "path string, text string"
    got = RN.renames(spark.createDataFrame(deleted, schema), spark.createDataFrame(added, schema)).collect()
    want = by_hand(deleted, added, 0.5)
    assert {r.old_path: r.new_path for r in got} == {p: q for p, (q, _) in want.items()} and len(got) == len({r.new_path for r in got})
    assert all(abs(r.score - want[r.old_path][1]) < 1e-9 for r in got) and 8 < len(got) < 17


# report documents -------------------------------------------------------------------

def test_report_documents(spark, tmp_path):
    rng = random.Random(1)
    rows = [("en", f"f{rng.randrange(9)}.md", i, f'o "{i}" журнал\n', "t\\" * rng.randrange(200), "r\x01") for i in range(300)] + [("es", "a.md", 0, "o", "t", "r")]
    kept = spark.createDataFrame(rows, "lang string, file_path string, pos int, original string, translated string, reason string").repartition(5)
    files = spark.createDataFrame([("en",)] * 9 + [("es",), ("zh",)], "lang string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_report_documents(files, kept, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    names = ("file_path", "original", "translated", "reason")
    for lang, n in (("en", 9), ("es", 1), ("zh", 1)):
        doc = json.loads((tmp_path / f"validation_report_{lang}.json").read_text(encoding="utf-8"))
        want = [dict(zip(names, (r[1], *r[3:]))) for r in sorted(r for r in rows if r[0] == lang)]
        assert doc == {"language": lang, "total_files": n, "total_issues": len(want), "issues": want} and list(doc) == ["language", "total_files", "total_issues", "issues"]
    assert "журнал" in (tmp_path / "validation_report_en.json").read_text(encoding="utf-8")
    assert sorted(p.name for p in tmp_path.iterdir()) == [f"validation_report_{x}.json" for x in ("en", "es", "zh")]
    assert report_pieces(files.limit(0), kept.limit(0)).count() == 0


def test_grams_of_a_text_have_only_lengths_of_terms(spark, monkeypatch):
    from docweave.operators import term_match
    asked, listed = [], term_match._text_grams

    def seen(n_keys, names, sizes):
        asked.append(sizes)
        return listed(n_keys, names, sizes)
    monkeypatch.setattr(term_match, "_text_grams", seen)
    rows = spark.createDataFrame([(1, "the internationalisation of ab"), (2, None), (3, "")], "id long, text string")
    terms = spark.createDataFrame([("internationalisation",), ("nationalistic",), ("ab",)], "term string")
    got = {r.id: r.found for r in term_match.match_terms(rows, ["id"], terms, automaton_chars=0).collect()}
    assert got == {1: ["ab", "internationalisation"], 2: [], 3: []}
    assert asked == [[2, term_match.GRAM]]
