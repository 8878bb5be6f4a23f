import datetime as dt
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tillcast.llm import entry, pseudonyms


def luhn(digits):
    doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def mod97(iban):
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


@pytest.fixture(scope="module")
def change(spark):
    def run(*texts, key="k"):
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
        return [(r["text"], r["n"]) for r in pseudonyms.replace(rows, key, count="n").orderBy("doc_id").collect()]

    return run


def test_formats(change):
    texts = [
        "4417744280351547", "4111 1111 1111 1111", "3782-822463-10005", "+1 (974) 555-3436", "(212) 555-0123",
        "212-555-0123", "078-05-1120", "129.38.82.176", "DE89370400440532013000", "1987-02-28", "28.02.1987",
        "1987/02/28", "a.b-c+d@mail4.example.com",
    ]
    out = change(*texts)
    assert all(n == 1 and new != old for old, (new, n) in zip(texts, out))
    for old, (new, _) in zip(texts, out):
        if old != "129.38.82.176":
            assert re.sub("[0-9]", "9", re.sub("[a-zA-Z]", "a", old)) == re.sub("[0-9]", "9", re.sub("[a-zA-Z]", "a", new))
    new = dict(zip(texts, (x for x, _ in out)))
    assert all(luhn(re.sub("[^0-9]", "", new[t])) for t in texts[:3])
    assert all(0 <= int(x) < 256 for x in new["129.38.82.176"].split("."))
    assert mod97(new["DE89370400440532013000"]) == 1 and new["DE89370400440532013000"].startswith("DE")
    day = dt.date.fromisoformat(new["1987-02-28"])
    assert new["28.02.1987"] == day.strftime("%d.%m.%Y") and new["1987/02/28"] == day.strftime("%Y/%m/%d")
    assert new["a.b-c+d@mail4.example.com"].endswith(".com")
    assert new["+1 (974) 555-3436"].startswith("+1 (")


def test_invalid_values_stay(change):
    texts = ["9807915762804490", "1987-02-29", "999.1.1.1", "666-12-1234", "DE00370400440532013000", "version 1.2.3",
             "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\""]
    assert change(*texts) == [(t, 0) for t in texts]


def test_same_value_same_pseudonym(change):
    a, b, c = change("x 4417744280351547 y", "4417744280351547, 4417744280351547!", "no value")
    value = a[0].split()[1]
    assert b == (f"{value}, {value}!", 2) and c == ("no value", 0)
    assert change("x 4417744280351547 y", key="other")[0][0] != a[0]


def test_text_around_stays(change):
    text = "Öffnen Sie\n\tjo.1@a.example.org; danach 10.0.0.1 — ende."
    new = change(text)[0][0]
    assert re.fullmatch(r"Öffnen Sie\n\t[a-z]{2}\.\d@[a-z]\.[a-z]{7}\.org; danach [\d.]+ — ende\.", new)


def shape(text):
    return re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text)))


def day_of(text):
    """The day by the documented order: a dot puts the day first, - and / the month, if the calendar allows it."""
    a, b, c = re.split("[-./]", text)
    if len(a) == 4:
        return dt.date(int(a), int(b), int(c))
    day_first = int(b) <= 12 if "." in text else int(a) > 12
    return dt.date(int(c), *((int(b), int(a)) if day_first else (int(a), int(b))))


def test_date_layouts(change):
    texts = [
        "12/31/1999", "31/12/1999", "31-12-1999", "12-31-1999", "31.12.1999", "1999-12-31", "1999.12.31",
        "1.2.1999", "01.02.1999", "1999-02-01", "2/1/1999", "2-1-1999", "1999/2/1", "1.02.1999", "13/5/2001", "29/2/2000",
    ]
    out = change(*texts)
    assert all(n == 1 and new != old and shape(new) == shape(old) for old, (new, n) in zip(texts, out))
    # Every layout of a day shows the same pseudonym.
    for group in (range(7), range(7, 14)):
        assert len({day_of(out[i][0]) for i in group}) == 1
    assert change("born 12/31/1999, moved 1.2.1999.")[0][1] == 2
    stay = ["31/31/1999", "30/2/2000", "29.2.1999", "0/5/1999", "13.13.2001", "1/2/1799", "1.2.3.1999", "1/2/99"]
    assert change(*stay) == [(t, 0) for t in stay]


def test_dates_with_the_year_last_are_one_to_one(spark):
    days = spark.range(146_097).select(F.date_add(F.lit("1800-01-01"), F.col("id").cast("int")).alias("d"))
    for layout in ("d.M.yyyy", "M/d/yyyy"):
        texts = days.select(F.date_format("d", layout).alias("v"))
        new = texts.select("v", F.transform(F.array("v"), lambda v: pseudonyms._date(v, F.lit("k")))[0].alias("w"))
        assert new.distinct().count() == new.select("w").distinct().count() == 146_097
        assert new.where(F.length("v") != F.length("w")).count() == 0
    late = days.where("day(d) > 12").select(F.date_format("d", "dd/MM/yyyy").alias("v"))
    new = late.select(F.transform(F.array("v"), lambda v: pseudonyms._date(v, F.lit("k")))[0].alias("w"))
    assert new.where("int(left(w, 2)) > 12").distinct().count() == late.count()


def test_ibans_in_groups(change):
    texts = ["DE89 3704 0044 0532 0130 00", "GB29-NWBK-6016-1331-9268-19", "NO93 8601 1117 947", "AT61\u00a01904\u00a03002\u00a03457\u00a03201"]
    out = change(*texts)
    assert all(n == 1 and new != old and shape(new) == shape(old) for old, (new, n) in zip(texts, out))
    bare = change(*[re.sub("[^A-Z0-9]", "", t) for t in texts])
    assert [re.sub("[^A-Z0-9]", "", new) for new, _ in out] == [new for new, _ in bare]
    assert all(mod97(new) == 1 for new, _ in bare)
    # Words and numbers around it are no groups of it; a card in what is no IBAN still goes.
    (new, n), = change("IBAN AT61 1904 3002 3457 3201 BIC4 1234, DE89 3704 0044 0532 0130 00 2500 EUR")
    assert n == 2 and new.startswith("IBAN AT") and " BIC4 1234, DE" in new and new.endswith(" 2500 EUR")
    (new, n), = change("DE12 4111 1111 1111 1111 22")
    assert n == 1 and new.startswith("DE12 ") and new.endswith(" 22") and luhn(new[5:24].replace(" ", ""))
    assert "4111" not in change("NR12 4111 1111 1111 1111 X")[0][0]
    assert change("DE88 3704 0044 0532 0130 00") == [("DE88 3704 0044 0532 0130 00", 0)]


def test_mails_after_punctuation(change):
    mail = change("john@x.com")[0][0]
    texts = ["-john@x.com", "_john@x.com_", "--john@x.com", "**_john@x.com_**", "+john@x.com", "%john@x.com", "...john@x.com"]
    assert change(*texts) == [(t.replace("john@x.com", mail), 1) for t in texts]
    (whole, n), = change("a.-john@x.com")
    assert n == 1 and "john" not in whole and not whole.startswith("a.-" + mail)


def test_permutations_are_one_to_one(spark):
    days = spark.range(146_097).select(F.date_add(F.lit("1800-01-01"), F.col("id").cast("int")).cast("string").alias("v"))
    new = days.select(F.transform(F.array("v"), lambda v: pseudonyms._date(v, F.lit("k")))[0].alias("w"))
    assert new.distinct().count() == 146_097
    numbers = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    new = numbers.select(F.transform(F.array("v"), lambda v: pseudonyms._digits(v, F.lit("k"), "t"))[0].alias("w"))
    assert new.distinct().count() == 1000 and new.where(F.length("w") == 3).count() == 1000


def test_query(spark, folder, documents):
    rows = {r["doc_id"]: r for r in entry.QUERIES["op4_pseudonyms"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text in documents:
        row = rows[doc_id]
        mails = re.findall(r"[\w.]+@[\w.]+\.com", text or "")
        cards = [x for x in re.findall(r"(?<!\d)\d{16}(?!\d)", text or "") if luhn(x)]
        assert not any(x in row["text"] for x in mails + cards)
        if not re.search("[0-9@]", text or ""):
            assert (row["text"], row["n_values"]) == (text, 0)


def test_edges(edges, nothing):
    out = pseudonyms.replace(edges, "k")
    assert out.columns == edges.columns and sorted(map(str, out.collect())) == sorted(map(str, edges.collect()))
    counted = pseudonyms.replace(edges, "k", count="n_words")
    assert counted.columns == [c for c in edges.columns if c != "n_words"] + ["n_words"]
    assert pseudonyms.replace(nothing, "k").count() == 0


def test_addresses_of_any_script_are_whole(change):
    texts = ["jürgen@x.com", "Иван.Петров7@почта.рф", "john@münchen.de", "x έρως@site.gr y", "jose\u0301@x.org", "李@例子.中国"]
    for old, (new, n) in zip(texts, change(*texts)):
        assert n == 1 or old.startswith("李")
        top = old.split()[1 if " " in old else 0].rsplit(".", 1)[1]
        assert len(new) == len(old) and re.search(rf"@\S*\.{top}\b", new)
        local, was = (re.search(r"(\S+)@", t)[1] for t in (new, old))
        assert n == 0 or local != was
    new = change("jürgen@x.com")[0][0]
    assert re.fullmatch(r"[a-z][ß-ÿ][a-z]{4}@[a-z]\.com", new)
    assert change("danke, jürgen@x.com!")[0][0] == f"danke, {new}!"


def test_listed_gaps_stay(change):
    texts = ["212 555 0123", "0171 2345678", "2001:db8::ff00:42:8329", "41111111 11111111", "078051120"]
    assert change(*texts) == [(t, 0) for t in texts]


def drawn(key, kind, turn, other):
    data = "|".join([key, kind, str(turn), str(other), key])
    return int(hashlib.sha256(data.encode()).hexdigest()[:15], 16)


def feistel(key, kind, a, b, lefts, rights):
    """The network by itself: eight turns, each half moved by a keyed number drawn from the other."""
    for turn in range(8):
        if turn % 2 == 0:
            a = (a + drawn(key, kind, turn, b)) % lefts
        else:
            b = (b + drawn(key, kind, turn, a)) % rights
    return a, b


def test_permutations_against_plain_python(change):
    pick = random.Random(2)
    key = "another key"
    cards, areas = [], []
    while len(cards) < 15:
        digits = "".join(pick.choices("0123456789", k=16))
        cards += [digits] if luhn(digits) else []
    while len(areas) < 15:
        area, group, serial = pick.randrange(1, 900), pick.randrange(1, 100), pick.randrange(1, 10_000)
        areas += [(area, group, serial)] if area != 666 else []
    new = [text for text, _ in change(*cards, *[f"{a:03}-{g:02}-{s:04}" for a, g, s in areas], key=key)]
    for card, got in zip(cards, new):
        a, b = feistel(key, "card", int(card[:7]), int(card[7:15]), 10**7, 10**8)
        assert got == next(n for d in "0123456789" if luhn(n := f"{a:07}{b:08}{d}"))
    for (area, group, serial), got in zip(areas, new[15:]):
        a, b = feistel(key, "ssn", (area - (2 if area > 666 else 1)) * 99 + group - 1, serial - 1, 898 * 99, 9999)
        at = a // 99
        assert got == f"{at + (2 if at >= 665 else 1):03}-{a % 99 + 1:02}-{b + 1:04}"


def test_the_key_is_needed_and_in_no_plan(spark, capsys):
    docs = spark.createDataFrame([(1, "call 212-555-0123")], "doc_id long, text string")
    with pytest.raises(ValueError):
        pseudonyms.replace(docs, "")
    new = pseudonyms.replace(docs, "a-very-secret-key")
    new.explain("extended")
    new.explain("codegen")
    shown = capsys.readouterr().out
    assert "subquery" in shown and "secret" not in shown
