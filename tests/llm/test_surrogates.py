import re

from cohortlift.llm import surrogates as S


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


ROWS = [
    (1, "Anna Schmidt met Ms. Schmidt. Call +1 (974) 555-3436 or 974-555-3436, A.b@C.com or a.b@c.com."),
    (2, "Cards 4417744280351547 and 4417 7442 8035 1547, decoy 4417744280351548, ip 10.1.2.3, no ip 999.1.1.1, 123-45-6789!"),
    (3, 'Иван Петров и Анна Петрова, Hans Schmidt; token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" end'),
    (4, None), (5, ""), (6, "A clean text, version 3.5 of 2024-01-02 and 12345678."), (None, "a.b@c.com"), (1, "a.b@c.com"), (7, "x " * 100_000 + "a.b@c.com" + " y" * 100_000),
]


def replaced(spark, rows=ROWS, **more):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, norm string, n_entities int").repartition(3)
    out = S.replace_personal_data(docs, **more)
    assert out.columns == ["doc_id", "text", "norm", "n_entities"]
    return out.collect()


def test_surrogates_keep_type_format_and_coreference(spark):
    got = replaced(spark)
    assert len(got) == len(ROWS)
    by = {(r["doc_id"], r["n_entities"]): r["text"] for r in got}
    one = re.fullmatch(r"(\w+) (\w+) met Ms\. (\w+)\. Call \+1 \((\d{3})\) (\d{3})-(\d{4}) or (\d{3})-(\d{3})-(\d{4}), (\S+@\S+) or (\S+@\S+)\.", by[(1, 6)])
    assert one[1] in S.GIVEN[("latin", "f")].split() and one[1] != "Anna" and one[2] == one[3] != "Schmidt" and one[2].istitle()
    assert one.group(4, 5, 6) == one.group(7, 8, 9) != ("974", "555", "3436")
    assert one[10].lower() == one[11].lower() != "a.b@c.com" and re.fullmatch(r"[a-z]\.[a-z]@[a-z]\.example\.com", one[11])
    assert {r["text"].strip(" xy") for r in got if r["n_entities"] == 1} == {one[11]}
    two = re.fullmatch(r"Cards (\d{16}) and (\d{4} \d{4} \d{4} \d{4}), decoy 4417744280351548, ip (\S+), no ip 999\.1\.1\.1, (9\d\d-\d\d-\d{4})!", by[(2, 4)])
    assert two[1] == two[2].replace(" ", "") != "4417744280351547" and luhn(two[1]) and two[1][0] == "4"
    assert all(0 < int(x) < 255 for x in two[3].split(".")) and two[3] != "10.1.2.3"
    three = re.fullmatch(r'(\w+) (\w+) и (\w+) (\w+), (\w+) (\w+); token = "([0-9a-f]{40})" end', by[(3, 4)])
    assert three[1] in S.GIVEN[("cyrillic", "m")].split() and three[3] in S.GIVEN[("cyrillic", "f")].split()
    assert three[4] == three[2] + "а" and three[6] == one[2] and three[5] in S.GIVEN[("latin", "m")].split()
    assert by[(6, 0)] == ROWS[5][1] and by[(4, 0)] is None and by[(5, 0)] == ""


def test_keys_and_reruns(spark):
    text = lambda rows: sorted(str(r["text"]) for r in rows)
    assert text(replaced(spark, ROWS[:3])) == text(replaced(spark, ROWS[:3]))
    assert text(replaced(spark, ROWS[:3])) != text(replaced(spark, ROWS[:3], key="another"))


def test_collisions_are_drawn_again(spark):
    # Ten thousand addresses of one letter and digit each share few shapes, surrogates still differ and none is real.
    names = [f"{a}{b}@{c}{d}.com" for a in "abcdefghij" for b in "0123456789" for c in "abcdefghij" for d in "01234"]
    found = spark.createDataFrame([("email", n) for n in names] + [("ip", f"1.2.3.{i}") for i in range(50)], "kind string, norm string")
    drawn = S.draw_surrogates(found, "k").collect()
    made = [(r["kind"], r["s"]) for r in drawn]
    assert len(made) == len(set(made)) == len(names) + 50
    assert not {s for _, s in made} & set(names)


def test_given_names_stay_distinct(spark):
    for names in S.GIVEN.values():
        known = [n.lower() for n in names.split()]
        rows = spark.createDataFrame([(n,) for n in known], "n string").select("n", S._given(S.F.col("n"), "k").alias("s")).collect()
        assert sorted(r["s"] for r in rows) == sorted(known) and all(r["n"] != r["s"] for r in rows)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a.b@c.com")], "doc_id long, text string")
    plan = S.replace_personal_data(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert S.replace_personal_data(docs.limit(0)).count() == 0


def texts_of(spark, texts):
    rows = replaced(spark, list(enumerate(texts)))
    return {r["doc_id"]: (r["text"], r["n_entities"]) for r in rows}


def test_a_title_takes_given_names_and_surname(spark):
    got = texts_of(spark, [
        "we saw Mr. Peter Smith and Dr. Anna Keller.", "then Peter Smith left", "and Ms Keller, Herr Dr. J. Keller, Dr. Anna von Keller.", "as Peter John Smith said",
    ])
    one = re.fullmatch(r"we saw Mr\. (\w+) (\w+) and Dr\. (\w+) (\w+)\.", got[0][0])
    assert one[1] in S.GIVEN[("latin", "m")].split() and one[3] in S.GIVEN[("latin", "f")].split()
    assert not {"Peter", "Smith", "Anna", "Keller"} & set(one.groups())
    assert got[1][0] == f"then {one[1]} {one[2]} left"
    three = re.fullmatch(r"and Ms (\w+), Herr Dr\. ([A-Z])\. (\w+), Dr\. (\w+) von (\w+)\.", got[2][0])
    assert three[1] == three[3] == three[5] == one[4] and three[4] == one[3] and three[2] != "J" and got[2][1] == 3
    four = re.fullmatch(r"as (\w+) (\w+) (\w+) said", got[3][0])
    assert four[1] == one[1] and four[3] == one[2] and four[2] != "John"


def test_names_need_no_list(spark):
    got = texts_of(spark, [
        "John Smith met Mary Jones. Yesterday John Smith called", "Mr. Smith and Mary J. O'Neil, Сергея Волков.",
        "under the Apache License, Version 2.0, the GNU General Public License, Orre Orre Orre, On Monday The Red House, All Rights Reserved.",
    ])
    one = re.fullmatch(r"(\w+) (\w+) met (\w+) (\w+)\. Yesterday (\w+) (\w+) called", got[0][0])
    assert one.group(1, 2) == one.group(5, 6) and len({*one.groups(), "John", "Smith", "Mary", "Jones"}) == 8
    two = re.fullmatch(r"Mr\. (\w+) and (\w+) ([A-Z])\. (\w+), (\w+) (\w+ов)\.", got[1][0])
    assert two[1] == one[2] and two[2] == one[3] and two[3] != "J" and two[6] != "Волков"
    assert got[2][1] == 0


def test_phones_of_other_countries(spark):
    texts = ["at +49 30 1234567 or 0049 30 1234567, +49 (0)30 1234567.", "+33 1 23 45 67 89!", "+19745553436 or 974-555-3436", "+1.23456789 and 12345678 and 2024-01-02"]
    got = texts_of(spark, texts)
    one = re.fullmatch(r"at \+49 (\d\d) (\d{7}) or 0049 (\d\d) (\d{7}), \+49 \(0\)(\d\d) (\d{7})\.", got[0][0])
    assert one.group(1, 2) == one.group(3, 4) == one.group(5, 6) != ("30", "1234567") and got[0][1] == 3
    assert re.fullmatch(r"\+33 \d \d\d \d\d \d\d \d\d!", got[1][0]) and got[1][0] != texts[1]
    three = re.fullmatch(r"\+1(\d{10}) or (\d{3})-(\d{3})-(\d{4})", got[2][0])
    assert three[1] == three[2] + three[3] + three[4] != "9745553436"
    assert got[3] == (texts[3], 0)


def test_assigned_secrets(spark):
    value = "Abc123def456Ghi789"
    texts = [f"key={value}, API_KEY: {value}", f'"token": "{value}"', "password=hunter! pwd = 123456", "key: important; key=lambda, the token was", "api_key=4417744280351548"]
    got = texts_of(spark, texts)
    one = re.fullmatch(r"key=([A-Z]\w{17}), API_KEY: (\w{18})", got[0][0])
    assert one[1] == one[2] != value and got[1][0] == f'"token": "{one[1]}"'
    assert re.fullmatch(r"password=[a-z]{6}! pwd = \d{6}", got[2][0]) and "hunter" not in got[2][0] and "123456" not in got[2][0]
    assert got[3] == (texts[3], 0) and got[4][0] != texts[4] and got[4][1] == 1


def test_full_shapes_and_clashing_columns(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(f"write to {a}@{b}.com", "t", "k", "h") for a in letters for b in letters]
    docs = spark.createDataFrame(rows, "text string, _tokens string, _KNOWN string, _hk string")
    out = S.replace_personal_data(docs)
    assert out.columns == [*docs.columns, "n_entities"]
    got = [r["text"].removeprefix("write to ") for r in out.collect()]
    assert len(set(got)) == 676 and not set(got) & {r[0].removeprefix("write to ") for r in rows}
    assert out.where("_tokens = 't' and _KNOWN = 'k' and _hk = 'h' and n_entities = 1").count() == 676
