import datetime
import hashlib
import re

from matchlake.llm.pseudonyms import Settings, pseudonymise

KEY = Settings(key="k")


def luhn(digits):
    total = 0
    for i, d in enumerate(int(x) for x in reversed(digits)):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def rewritten(docs, *texts, settings=KEY):
    return [(r["text"], r["pii"].asDict()) for r in pseudonymise(docs(*enumerate(texts)), settings).orderBy("doc_id").collect()]


def test_formats_stay_and_values_stay_linked(docs):
    text = "card 4111 1111 1111 1111, again 4111-1111-1111-1111; a.b@c.org 123-45-6789 +1 (743) 555-3824 10.0.0.1 2001-02-28 31.12.1999 12/31/1999"
    (one, counts), (two, _) = rewritten(docs, text, "x 4111111111111111 y " + text)
    assert counts == {"mail": 1, "card": 2, "ssn": 1, "phone": 1, "ip": 1, "date": 3}
    form = r"card (\d{4} \d{4} \d{4} \d{4}), again (\d{4}-\d{4}-\d{4}-\d{4}); \S+@\S+\.example \d{3}-\d\d-\d{4} \+1 \(\d{3}\) \d{3}-\d{4} [\d.]+ \d{4}-\d\d-\d\d \d\d\.\d\d\.\d{4} \d\d/\d\d/\d{4}"
    found = re.fullmatch(form, one)
    assert found and found[1].replace(" ", "") == found[2].replace("-", "") and luhn(found[1].replace(" ", ""))
    assert two == f"x {found[1].replace(' ', '')} y {one}"
    assert not any(x in one for x in ("4111", "6789", "3824", "10.0.0.1", "2001-02-28"))


def test_invalid_values_and_plain_texts_stay(docs):
    texts = ["4111111111111112", "1.2.3.4.5 300.1.1.1 v1.2.3.4", "2001-02-30 1600-01-01", "666-12-3456 000-11-2222", "a4111111111111111", "", "no digits @ all", "0000000000000000"]
    assert [x for x, _ in rewritten(docs, *texts)] == texts


def test_permutations_do_not_collide(docs):
    ips = [f"10.0.{i // 256}.{i % 256}" for i in range(600)]
    days = [f"{1990 + i // 28}-02-{1 + i % 28:02d}" for i in range(600)]
    numbers = [f"{100 + i // 9000:03d}-{1 + i % 99:02d}-{1 + i:04d}" for i in range(600)]
    ((text, counts),) = rewritten(docs, " ".join(ips + days + numbers))
    assert counts["ip"] == counts["date"] == counts["ssn"] == 600
    assert len(set(text.split())) == 1800
    assert all(0 <= int(x) <= 255 for ip in text.split()[:600] for x in ip.split("."))
    for value in text.split()[1200:]:
        area, group, serial = map(int, value.split("-"))
        assert 1 <= area <= 899 and area != 666 and group and serial


def test_keys_differ(docs):
    assert rewritten(docs, "10.0.0.1")[0][0] != rewritten(docs, "10.0.0.1", settings=Settings(key="other"))[0][0]


def test_columns_nulls_and_long_texts(docs, spark):
    frame = docs((1, None), (None, "5 " * 50_000 + "10.0.0.1"), (2, "x@y.org"), (2, "x@y.org")).withColumnRenamed("score", "pieces")
    rows = pseudonymise(frame, KEY, counts=False).collect()
    assert pseudonymise(frame, KEY, counts=False).columns == frame.columns
    assert [r["text"] for r in rows if r["doc_id"] == 1] == [None] and len({r["text"] for r in rows if r["doc_id"] == 2}) == 1
    assert [len(r["text"].split()) for r in rows if r["doc_id"] is None] == [50_001]
    assert pseudonymise(frame.limit(0), KEY).count() == 0
    plan = pseudonymise(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), KEY)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_international_numbers_as_written(docs):
    numbers = ["+49 30 12345678", "+44 20 7946 0958", "+33 1 23 45 67 89", "+49 (30) 1234-5678", "+34.912.345.678", "+44 (0)20 7946 0958"]
    rows = pseudonymise(docs(*((i, f"Tel. {x}, bitte") for i, x in enumerate(numbers))), Settings(key="k")).orderBy("doc_id").collect()
    for number, row in zip(numbers, rows, strict=True):
        shape = lambda text: "".join("9" if c.isdigit() else c for c in text)
        assert row["pii"]["phone"] == 1 and number not in row["text"] and shape(row["text"]) == shape(f"Tel. {number}, bitte")
    (row,) = pseudonymise(docs((1, "+1 23 45 and + 12 34 56 78")), Settings(key="k")).collect()
    assert row["text"] == "+1 23 45 and + 12 34 56 78"
    (row,) = pseudonymise(docs((1, "+49 30 1234567 4111 1111 1111 1111")), Settings(key="k")).collect()
    assert (row["pii"]["phone"], row["pii"]["card"]) == (1, 1)


def permuted(kind, left, right, size_left, size_right, key="k", rounds=10):
    """The Feistel network once more, number by number."""
    for i in range(1, rounds + 1):
        of, size = (right, size_left) if i % 2 else (left, size_right)
        mask = int(hashlib.sha256(f"{key}|{kind}|{i}|{size_left}|{of}".encode()).hexdigest()[:15], 16) % size
        left, right = ((left + mask) % size_left, right) if i % 2 else (left, (right + mask) % size_right)
    return left, right


def refilled(form, digits):
    digits = iter(digits)
    return "".join(next(digits) if c.isdigit() else c for c in form)


def halves(kind, body):
    u = len(body) // 2
    left, right = permuted(kind, int(body[:u] or 0), int(body[u:]), 10**u, 10 ** (len(body) - u))
    return f"{left:0{u}d}{right:0{len(body) - u}d}"


def one_by_one(value):
    digits = re.sub("[^0-9]", "", value)
    if "@" in value:
        h = hashlib.sha256(f"k|mail|{value.lower()}".encode()).hexdigest()
        return f"u{h[:12]}@{h[12:20]}.example"
    if re.fullmatch(r"\d{3}-\d\d-\d{4}", value):
        area, group, serial = (int(x) for x in value.split("-"))
        left, right = permuted("ssn", area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 989901)
        return f"{left + 1 + (left >= 665):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"
    if re.fullmatch(r"\d{4}-\d\d-\d\d", value):
        number = (datetime.date.fromisoformat(value) - datetime.date(1800, 1, 1)).days
        left, right = permuted("date", number // 773, number % 773, 189, 773)
        return str(datetime.date(1800, 1, 1) + datetime.timedelta(left * 773 + right))
    if value.count(".") == 3 and value[0] != "+":
        a, b, c, d = (int(x) for x in value.split("."))
        left, right = permuted("ip", a * 256 + b, c * 256 + d, 65536, 65536)
        return ".".join(str(x) for x in (left // 256, left % 256, right // 256, right % 256))
    if value.startswith("+") or "(" in value:
        return refilled(value, digits[:-10] + halves("phone", digits[-10:]))
    body = halves("card", digits[:-1])
    check = next(c for c in "0123456789" if luhn(body + c))
    return refilled(value, body + check)


def test_every_value_equals_a_second_network(docs):
    values = ["4111 1111 1111 1111", "5500-0000-0000-0004", "378282246310005", "123-45-6789", "899-99-9999", "665-01-0001", "667-01-0001"]
    values += ["+1 (743) 555-3824", "+49 30 12345678", "+34.912.345.678", "10.0.0.1", "255.255.255.255", "2001-02-28", "1800-01-01", "2199-12-31", "A.b@c.Org"]
    ((text, counts),) = rewritten(docs, " ; ".join(values))
    assert text.split(" ; ") == [one_by_one(v) for v in values]
    assert counts == {"mail": 1, "card": 3, "ssn": 4, "phone": 3, "ip": 2, "date": 3}


def test_the_sample_equals_a_second_network(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before = {r.doc_id: r.text for r in frame.collect()}
    after = {r.doc_id: r.text for r in pseudonymise(frame, KEY).collect()}
    plain = re.compile(r"(?<![\w.%+-])[\w.%+-]+@[\w-]+\.[A-Za-z]+(?![\w.-])|(?<![\w.+-])\d{3}-\d\d-\d{4}(?![\w.-])|\+1 \(\d{3}\) \d{3}-\d{4}(?![\w.-])")
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i] != after[i]]
    seen = 0
    for i in changed:
        for m in plain.finditer(before[i]):
            assert one_by_one(m[0]) in after[i] or "000" in m[0]
            seen += 1
    assert seen > 5


def test_where_addresses_end(docs):
    kept = {"a@b.org.": ".", "a@b.org.1": ".1", "a@b.org1x": "1x", "a@b.c.dd-e": "-e", "a@b..org": None, "a@b": None, "a@b.c": None, "a@b.c.de.f.gh": ""}
    rows = rewritten(docs, *kept)
    for (text, counts), (before, rest) in zip(rows, kept.items(), strict=True):
        assert counts["mail"] == (rest is not None) and (text == before if rest is None else re.fullmatch(r"u\w{12}@\w{8}\.example" + re.escape(rest), text))
    ((text, counts),) = rewritten(docs, "root@10.0.0.1")
    assert counts["ip"] == 1 and text == "root@" + one_by_one("10.0.0.1")


def test_no_text_overflows_the_stack(docs):
    n = 100_000
    hostile = ["a@" + "b." * n, "a@" + "bb." * n, "a@" + "bb.c." * n + "dd", "1" * n, "1." * n, "1-" * n, "(" * n, "+" * n, "+1 " * n, "@" * n, "1 " * n, "a@b.cc " * 2000, "+1(2)" * n]
    rows = rewritten(docs, *hostile)
    assert rows[2][1]["mail"] == 1 and rows[11][1]["mail"] == 2000 and len(rows) == len(hostile)


def test_the_key_is_not_in_the_plan(docs):
    frame = pseudonymise(docs((1, "10.0.0.1")), Settings(key="very-secret-key"))
    assert "very-secret-key" not in frame._jdf.queryExecution().toString()
    frame.collect()
    assert "very-secret-key" not in frame._jdf.queryExecution().toString() + repr(Settings(key="very-secret-key"))
