from __future__ import annotations

import re
import textwrap
from collections import Counter

from pyspark.sql import functions as F

from millrace.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), n < 10 or 100 * len(covered) > 20 * n,
    )


FIELDS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(docs):
    for row in quality.judge(docs, verdict="judged").select("text", *[f"judged.{f}" for f in FIELDS]).collect():
        assert tuple(row[f] for f in FIELDS) == brute(row["text"]), row["text"][:80]


def test_base_measures(documents):
    check(documents)


def test_base_measures_of_odd_rows(odd, no_rows):
    check(odd)
    assert quality.judge(no_rows, verdict="judged").count() == 0


def test_repeated_windows(spark):
    texts = ["a b c d e a b c d e", "a a a a a a", "a a a a a", "x a b c d e y a b c d e f g h i j k l m", "a b c d e " * 3000]
    check(spark.createDataFrame([(t,) for t in texts], "text string"))


def verdicts(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return [r for r in quality.judge(rows).select("i", "quality.*").orderBy("i").collect()]


GOOD = "A line of prose that goes on for a while, and then ends."


def test_lines_that_fail_are_removed(spark):
    nav = "Home | About | News | Contact | Login"
    noise = "Buy%%% now$$$ and*** here### it&&& is!!"
    plain = "menu entries without any mark at all in the line"
    legal = "Read our privacy policy."
    for bad in (nav, noise, plain, legal):
        (row,) = verdicts(spark, f"{GOOD}\n{bad}\n{GOOD} {GOOD}")
        assert row["clean_text"] == f"{GOOD}\n{GOOD} {GOOD}", bad
        assert row["lost_words"] == len(bad.split()) and row["kept"] == (not row["base_failed"])


def test_a_document_that_loses_too_much_is_rejected(spark):
    nav = "Home | About | News | Contact | Login | Help"
    other = "Some different words stand in this line, for once."
    more = "Shop | Blog | Jobs | Press | Legal"
    rejected, clean = verdicts(spark, f"{nav}\n{more}\n{other}", f"{GOOD}\n{other}")
    assert not rejected["base_failed"] and not rejected["kept"]
    assert clean["kept"] and clean["lost_words"] == 0


def test_labelled_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge(docs, verdict="judged").join(labels, "doc_id").where("NOT judged.base_failed")
    rows = judged.select("judged.kept", F.col("quality").alias("q"))
    counts = {(r["kept"], r["q"]): r["count"] for r in rows.groupBy("kept", "q").count().collect()}
    assert counts.get((False, 1), 0) == 0
    assert counts.get((True, 0), 0) <= 0.1 * counts[False, 0]


def test_clean_keeps_columns(odd, documents):
    out = quality.clean(odd)
    assert out.columns == odd.columns and out.schema == odd.schema
    changed = quality.clean(documents).where(F.length("text") != F.col("n_chars"))
    assert changed.count() == documents.where(F.length("text") != F.col("n_chars")).count()


def cleaned(spark, *texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    return {r["i"]: r["text"] for r in quality.clean(rows).collect()}


def test_clean_documents_stay_whole(spark):
    others = [
        "यह एक वाक्य है जिसमें बहुत से शब्द आते हैं और फिर वह यहाँ समाप्त होता है।",
        "یہ ایک جملہ ہے جس میں بہت سے الفاظ ہیں اور پھر وہ یہاں ختم ہوتا ہے۔",
        "هل هذه جملة فيها كلمات كثيرة جدا ثم تنتهي هنا في آخر السطر الطويل؟",
        "սա մի նախադասություն է որի մեջ շատ բառեր կան և հետո այն ավարտվում է այստեղ։",
        "ይህ ብዙ ቃላት ያሉት አንድ ዓረፍተ ነገር ነው ከዚያም እዚህ ጋር በደንብ ያበቃል።",
        "នេះ ជា ប្រយោគ មួយ ដែល មាន ពាក្យ ច្រើន ហើយ វា ចប់ នៅ ទីនេះ។",
        "ဒါ က စကားလုံး များစွာ ပါ သော ဝါကျ တစ်ခု ဖြစ်ပြီး ဒီမှာ ဆုံး ပါ တယ်။",
        "นี่ คือ ประโยค ที่ มี คำ มากมาย และ จบ ลง ที่ นี่ อย่าง ดี",
    ]
    wrapped = textwrap.fill(
        "Der Zug fuhr am frühen Morgen aus dem Bahnhof der Stadt und nahm nach einer Weile den Weg durch das Tal hinauf zu "
        "den Bergen wo der Schnee noch lag und niemand auf die Reisenden wartete die alle müde waren.",
        50,
    )
    marks = f"# Introduction\n* buy milk\nR&D budget\n50% growth\n{GOOD}\nSome different words stand in this line, for once."
    texts = [*others, wrapped, marks, wrapped + "\n\n" + GOOD]
    assert cleaned(spark, *texts) == dict(enumerate(texts))


def test_bad_lines_still_go(spark):
    other = "Some different words stand in this line, for once, and there are quite a few of them."
    bad = [
        "Home | About | News | Contact | Login", "Buy%%% now$$$ and*** here### it&&& is!!",
        "menu entries without any mark at all in the line", "Read our privacy policy.",
    ]
    got = cleaned(spark, *[f"{GOOD}\n{b}\n{other}" for b in bad], "x\n+y\n-z\n\n" + GOOD)
    assert got == {**{i: f"{GOOD}\n{other}" for i in range(len(bad))}, len(bad): "x\n+y\n-z\n\n" + GOOD}
