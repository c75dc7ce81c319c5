"""Surrogates for personal data, with DataFrame functions only.

E-mail addresses, phone numbers, IPv4 addresses, card numbers (with a valid check digit), social-security numbers, secrets
(quoted, or assigned to a keyword) and person names are found by pattern.  A name is what follows a title, what follows a
listed given name, or a run of two or three capitalised words whose neighbours do not speak against it.  Each distinct entity of the corpus, in a normal form that all its mentions
share, gets one keyed surrogate of its kind: a hash under ``key`` fills the shape of the original, given names are dealt
within their gender and script.  Surrogates that two entities share, or that are entities themselves, are drawn again
until none is left, so distinct entities stay distinct.  Mentions are rendered in their own format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlift.llm.scratch import free
from cohortlift.session import materialise

# Given names by script and gender, titles, and syllables of invented surnames.
GIVEN = {
    ("latin", "f"): "Anna Maria Julia Laura Sarah Emma Sophie Claire Marie Elena Lucia Carmen Helen Alice Emily Susan Linda Karen Nancy Petra Sabine Monika Ingrid Isabel",
    ("latin", "m"): "Peter Paul Thomas Michael David James Robert William Daniel Martin Stefan Klaus Hans Pierre Louis Antoine Carlos Miguel Pablo Diego Henry George Frank Kevin",
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
    ("cyrillic", "m"): "Иван Петр Сергей Алексей Дмитрий Николай Андрей Михаил",
}
PARTICLES = "von van der den zu ter de la du di da del bin al".split()
TITLES = "Mr Mrs Ms Dr Herr Frau Mme Sra Sr".split()
# Words that begin sentences or stand for dates; none is part of a name.
STOP = (
    "The This That These Those And But Or If When While Where Why How What Who In On At Of By For From With To As Is Are Was Were It He She We They You "
    "His Her Our Their My Your No Not Yes Then There Here After Before Since Until Yesterday Today Tomorrow Dear Hello Hi Thanks Regards Call Contact Ask "
    "Der Die Das Und Oder Aber Wenn Als Ein Eine Im Am Von Zu Mit Es Er Sie Wir Ich Le La Les Un Une Des Et Ou Mais Dans Avec Pour Il Elle Nous Vous "
    "El Los Las Una De Del Y Pero Con Para Por Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August "
    "September October November December Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag "
    "И В Но На Не Он Она Они Мы Вы Это Как Что Если Когда Для По"
).split()
# Last words of what bears a name but is no person.
HEADS = (
    "License Licence Version Foundation University College School Institute Street Road Avenue Square Park River Lake City County State States Kingdom Union "
    "Company Corporation Inc Ltd Corp Group Bank House Hotel Church Museum Court Council Committee Ministry Minister President Office Department Agency "
    "Association Society Party League Club Times Post News Press Journal Day Night Year Week Software Source Public Conditions Policy Terms Service Services "
    "Notice Rights Reserved York Zealand Africa America Europe Asia"
).split()
SYLLABLES = {
    "latin": "ba der fen gar hol kin lam mor nel pas ral sun tor vil wen zim".split(),
    "cyrillic": "бар вел гор дан жук зол кор лев мал нов пет рог сав тих фед чер".split(),
}
DRAWS = 24

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NAMES = "|".join(" ".join(GIVEN.values()).split())
_ANY = lambda words: "|".join(words)
_TITLE = rf"(?:{_ANY(TITLES)})"
_CAPITAL = r"(?:(?:Mc|Mac|[OD]['’])?\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)*+(?!\p{L}))"
_WORD = rf"(?!(?:{_ANY(STOP)}|{_ANY(TITLES)})(?!\p{{L}})){_CAPITAL}"
_PARTICLE = rf"(?:(?:{_ANY(PARTICLES)}) ){{0,2}}"
_LISTED = rf"(?:(?:{_NAMES})(?:-(?:{_NAMES}))*+)"
_KEYWORD = r"(?<![\p{L}\p{N}])(?:[A-Za-z0-9]{1,20}+[_-]){0,3}(?i:(?:api_?key|key|token|secret|password|passwd|passphrase|pwd))[\"']? {0,2}(?::=|=>|[=:]) {0,2}[\"']?"
# After these words also letters alone are a secret, if they are quoted or assigned by an equals sign.
_PASSWORD = r"(?<=(?i:secret|password|passwd|passphrase|pwd)[\"']? {0,2}(?:=>|:=|=|: {0,2}[\"']) {0,2}[\"']?)"
# A run of two or three capitalised words, not more; a word that begins a sentence is not of the run.
_ALONE = rf"(?<!(?<!\p{{L}})(?!(?:{_ANY(STOP)}) )\p{{Lu}}[\p{{L}}'’-]{{0,30}} )(?<!(?<!\p{{L}})(?i:the|a|an|this|in|at|der|die|das|dem|den|des|im|le|la|les|el|los|las) )"
_RUN = rf"(?=\p{{Lu}}){_ALONE}(?!(?<twice>\p{{L}}++) \k<twice>(?!\p{{L}}))(?:{_WORD} (?:\p{{Lu}}\. )?){{1,2}}(?!(?:{_ANY(HEADS)})(?!\p{{L}})){_WORD}(?! \p{{Lu}})"
_SEP = r"(?:[ ./-]|[ .-]?\(|\)[ .-]?)?"
_PHONE_END = r"(?![\p{L}\p{N}])"
PARTS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]*[A-Za-z0-9])+",
    "assigned": rf"{_KEYWORD}(?=(?:[^A-Za-z0-9\s\"']*[A-Za-z0-9]){{6}})(?=[^\s\"']*[0-9]|{_PASSWORD})[A-Za-z0-9_+/=.~!$%^*#@:-]{{5,}}[A-Za-z0-9_+/=-]",
    "secret": r"(?<=[\"'])[A-Za-z0-9_+/-]{32,}+(?=[\"'])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "phone": (
        rf"(?<![\p{{L}}\p{{N}}.+(-])(?:(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{3}}\) ?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}{_PHONE_END}"
        rf"|(?:\+(?=[1-9])(?!\d+\.\d+(?![\d.]))|00(?=[1-9]\d{{0,2}}[ ./(-]))\d(?:{_SEP}\d){{7,14}}{_PHONE_END})"
    ),
    "card": r"(?<![\p{L}\p{N}])(?:(?:\d{4} ){3}\d{1,7}|(?:\d{4}-){3}\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}|\d{13,19})(?![\p{L}\p{N}])",
    "titled": rf"(?<!\p{{L}})(?:{_TITLE}\.? )+(?:(?:{_WORD}|\p{{Lu}}\.) ){{0,2}}{_PARTICLE}{_WORD}",
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}}){_LISTED} (?:(?:{_WORD}|\p{{Lu}}\.) ){{0,2}}{_PARTICLE}{_WORD}",
    "run": rf"(?<!\p{{L}}){_RUN}",
}
_one_of = lambda *kinds: "(?:" + "|".join(PARTS[k] for k in kinds) + ")"
# No match begins inside a word, and its first character rules most kinds out.
PATTERN = (
    rf"(?<!\p{{L}})(?:{_one_of('email', 'assigned', 'secret')}|(?=[0-9+(]){_one_of('ip', 'ssn', 'phone', 'card')}"
    rf"|(?=\p{{Lu}}){_one_of('titled', 'person', 'run')})"
)
#: What any match holds; most texts stop here.
HINT = rf"[0-9@\"']|(?<!\p{{L}})\p{{Lu}}[\p{{L}}'’-]*\.? {_PARTICLE}\p{{Lu}}|{_KEYWORD}"
#: Calling codes of one or two digits; all others have three.
_CALLING = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"


def _chars(text: Column) -> Column:
    """Characters of a text that is not empty."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def _luhn_sum(digits: Column) -> Column:
    """Weighted digit sum of a number without its check digit."""

    def weighed(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(c.cast("int"))

    return F.aggregate(F.transform(F.reverse(_chars(digits)), weighed), F.lit(0), lambda a, x: a + x)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(token: Column) -> Column:
    """Kind of a match; null for a long number without a valid check digit, which is no entity."""
    digits = _digits(token)
    length = F.length(digits)
    valid = (_luhn_sum(digits.substr(F.lit(1), length - 1)) + digits.substr(length, F.lit(1)).cast("int")) % 10 == 0
    whole = lambda k: token.rlike(f"^{PARTS[k]}$")
    return (
        F.when(token.rlike(f"^{_KEYWORD}"), "assigned")
        .when(token.contains("@"), "email")
        .when(whole("ip"), "ip")
        .when(whole("ssn"), "ssn")
        .when(whole("phone"), "phone")
        .when(token.rlike("^[0-9][0-9 -]+$") & (length < 20), F.when(valid, "card"))
        .when(token.rlike("^[A-Za-z0-9_+/-]{32,}$"), "secret")
        .when(token.rlike(rf"^{_TITLE}\.? "), "titled")
        .otherwise("person")
    )


def _last_name(token: Column) -> Column:
    """A surname's normal form: Cyrillic names lose the female ending."""
    return F.regexp_replace(F.lower(F.element_at(F.split(token, " "), -1)), "(?<=[а-я])а$", "")


def _name_parts(token: Column) -> Column:
    """Words of a name without its titles; the last one is the surname."""
    return F.split(F.regexp_replace(token, rf"^(?:{_TITLE}\.? )+", ""), " ")


def _given_kind(word: Column) -> Column:
    return F.when(word.endswith("."), "initial").otherwise("given")


def _one_trunk(token: Column) -> Column:
    """A phone number without the zero in brackets, which is dialled only inside the country."""
    return F.regexp_replace(token, r"(?<=\d[ .-]?)\(0\)", "(o)")


def _phone_norm(token: Column) -> Column:
    """Ten national digits of a number of code 1 or without a code; else a plus, the code and the national digits."""
    digits = F.regexp_replace(_digits(_one_trunk(token)), "^00", "")
    ahead = token.rlike(r"^(?:\+|00)")
    return F.when((F.length(digits) == 11) & digits.startswith("1"), digits.substr(F.lit(2), F.lit(10))).when(
        ahead, F.concat(F.lit("+"), digits)
    ).otherwise(digits)


def entities(token: Column) -> Column:
    """(kind, norm) of what a match names: one, or given names and a surname."""
    kind, digits = kind_of(token), _digits(token)
    entry = lambda k, n: F.struct(F.lit(k).alias("kind") if isinstance(k, str) else k.alias("kind"), n.alias("norm"))
    surname = entry("surname", _last_name(token))
    parts = _name_parts(token)
    givens = F.transform(
        F.filter(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda n: ~n.isin(PARTICLES)), lambda n: entry(_given_kind(n), F.lower(n))
    )
    norm = (
        F.when(kind == "email", F.lower(token)).when(kind.isin("ip", "secret"), token).when(kind == "phone", _phone_norm(token))
        .when(kind == "assigned", F.regexp_replace(token, f"^{_KEYWORD}", "")).otherwise(digits)
    )
    return (
        F.when(kind.isNull(), F.array().cast("array<struct<kind:string,norm:string>>"))
        .when(kind.isin("titled", "person"), F.concat(givens, F.array(surname)))
        .when(kind == "assigned", F.array(entry("secret", norm)))
        .otherwise(F.array(entry(kind, norm)))
    )


def _drawn(stream: Column, i: Column, n: int) -> Column:
    """The i-th number below n of a hexadecimal stream of 256 digits."""
    at = F.pmod(i, F.lit(64)) * 4 + 1
    return F.pmod(F.conv(stream.substr(at.cast("int"), F.lit(4)), 16, 10).cast("int"), F.lit(n))


def _shaped(text: Column, stream: Column, skip: int = 0) -> Column:
    """Letters become letters and digits digits; the first ``skip`` characters and all others stay."""

    def one(c: Column, i: Column) -> Column:
        letter = lambda a: F.char(F.lit(a) + _drawn(stream, i, 26))
        return (
            F.when(i < skip, c).when(c.rlike("[0-9]"), _drawn(stream, i, 10).cast("string"))
            .when(c.rlike("[a-f]") & text.rlike("^[0-9a-f]+$"), F.char(F.lit(97) + _drawn(stream, i, 6)))
            .when(c.rlike(r"\p{Lu}"), letter(65)).when(c.rlike(r"\p{L}"), letter(97)).otherwise(c)
        )

    return F.array_join(F.transform(_chars(text), one), "")


def _given(norm: Column, key: str) -> Column:
    """Names of one gender and script move round by a keyed number of places: distinct names stay distinct."""
    out = norm
    for group, names in sorted(GIVEN.items()):
        known = [n.lower() for n in names.split()]
        shift = F.pmod(F.xxhash64(F.lit(key), F.lit("".join(group))), F.lit(len(known) - 1)) + 1
        listed = F.array(*map(F.lit, known))
        place = F.array_position(listed, norm)
        out = F.when(place > 0, F.element_at(listed, (F.pmod(place - 1 + shift, F.lit(len(known))) + 1).cast("int"))).otherwise(out)
    return out


def _is_listed(norm: Column) -> Column:
    return norm.isin([n.lower() for names in GIVEN.values() for n in names.split()])


def _initial(norm: Column, key: str) -> Column:
    """Initials of a script move round by a keyed number of places, as names do."""
    code, out = F.ascii(norm), norm
    for first, n in ((97, 26), (1072, 32)):
        shift = F.pmod(F.xxhash64(F.lit(key), F.lit(first)), F.lit(n - 1)) + 1
        moved = F.lit(first) + F.pmod(code - first + shift, F.lit(n))
        letters = F.lit("".join(chr(first + i) for i in range(n)))
        out = F.when(code.between(first, first + n - 1), F.concat(letters.substr((moved - first + 1).cast("int"), F.lit(1)), F.lit("."))).otherwise(out)
    return out


def surrogate(kind: Column, norm: Column, draw: Column, key: str) -> Column:
    """Surrogate of an entity, in normal form."""
    seed = lambda i: F.sha2(F.concat_ws("|", F.lit(key), kind, norm, draw.cast("string"), F.lit(str(i))), 256)
    stream = F.concat(*[seed(i) for i in range(4)])
    label = F.regexp_extract(norm, "@([^.]*)", 1)
    top = F.regexp_extract(norm, r"\.(com|net|org)$", 1)
    # An address of one letter before and behind the @ has few shapes; after some draws the part behind it becomes longer.
    longer = F.when(draw > 4, F.substring(stream, 33, 32).substr(F.lit(1), draw - 4)).otherwise("")
    email = F.concat(
        _shaped(F.regexp_extract(norm, "^([^@]*)", 1), stream), F.lit("@"), _shaped(label, F.reverse(stream)), longer,
        F.lit(".example."), F.when(top == "", "org").otherwise(top),
    )
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (_drawn(stream, i, 254) + 1).cast("string")), ".")
    head = (_drawn(stream, F.lit(63), 8) + 2).cast("string")
    code = F.when(norm.startswith("+"), F.concat(F.lit("+"), F.regexp_extract(norm.substr(F.lit(2), F.length(norm)), _CALLING, 0))).otherwise("")
    phone = F.concat(code, head, _shaped(norm, stream).substr(F.length(code) + 2, F.length(norm)))
    body = _shaped(norm, stream, 1).substr(F.lit(1), F.length(norm) - 1)
    card = F.concat(body, F.pmod(10 - F.pmod(_luhn_sum(body), F.lit(10)), F.lit(10)).cast("string"))
    ssn = F.concat(F.lit("9"), _shaped(norm, stream).substr(F.lit(2), F.length(norm)))

    def surname(script: str) -> Column:
        known = F.array(*map(F.lit, SYLLABLES[script]))
        n = len(SYLLABLES[script])
        pick = lambda i: F.element_at(known, (_drawn(stream, i, n) + 1).cast("int"))
        return F.array_join(F.transform(F.sequence(F.lit(0), F.least(draw, F.lit(20)) + 3), pick), "")

    cyrillic = F.concat(surname("cyrillic"), F.lit("ов"))
    ending = F.when(norm.rlike("[ая]$"), "а").otherwise("")
    given = F.when(_is_listed(norm), _given(norm, key)).otherwise(
        F.when(norm.rlike("[а-яё]"), F.concat(surname("cyrillic"), ending)).otherwise(surname("latin"))
    )
    # A short secret has few shapes; after some draws it becomes longer.
    secret = F.concat(_shaped(norm, stream), F.when(draw > 4, F.reverse(stream).substr(F.lit(1), draw - 4)).otherwise(""))
    return (
        F.when(kind == "email", email).when(kind == "ip", octets).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", ssn)
        .when(kind == "secret", secret).when(kind == "given", given).when(kind == "initial", _initial(norm, key))
        .otherwise(F.when(norm.rlike("[а-яё]"), cyrillic).otherwise(surname("latin")))
    )


def rendered(token: Column, known: Column) -> Column:
    """A mention in its own format; ``known`` maps kind and norm to surrogates."""
    kind, parts = kind_of(token), entities(token)
    of = lambda k, n: F.element_at(known, F.concat_ws("|", k, n))
    first = of(parts[0]["kind"], parts[0]["norm"])
    plain = _one_trunk(token)
    digits, found = _digits(plain), _digits(first)
    fill = F.concat(digits.substr(F.lit(1), F.length(digits) - F.length(found)), found)
    place = lambda i: F.length(_digits(plain.substr(F.lit(1), (i + 1).cast("int"))))
    numbered = F.array_join(
        F.transform(_chars(plain), lambda c, i: F.when(c.rlike("[0-9]"), fill.substr(place(i), F.lit(1))).otherwise(c)), ""
    )
    numbered = F.regexp_replace(numbered, r"\(o\)", "(0)")
    words = _name_parts(token)
    female = F.when(F.element_at(words, -1).rlike("[а-я]а$"), "а").otherwise("")
    surname = F.concat(F.initcap(of(F.lit("surname"), _last_name(token))), female)

    def word(w: Column, i: Column) -> Column:
        given = F.initcap(of(_given_kind(w), F.lower(w)))
        return F.when(i == F.size(words) - 1, surname).when(w.isin(PARTICLES), w).otherwise(given)

    name = F.concat(F.regexp_extract(token, rf"^(?:{_TITLE}\.? )*", 0), F.array_join(F.transform(words, word), " "))
    cased = F.when((F.upper(token) == token) & (F.lower(token) != token), F.upper(first)).otherwise(first)
    out = (
        F.when(kind == "email", cased).when(kind.isin("ip", "secret"), first).when(kind.isin("phone", "card", "ssn"), numbered)
        .when(kind == "assigned", F.concat(F.regexp_extract(token, f"^{_KEYWORD}", 0), first)).when(kind.isin("titled", "person"), name)
    )
    return F.coalesce(out, token)


def draw_surrogates(found: DataFrame, key: str) -> DataFrame:
    """``(kind, norm, s)`` of distinct entities ``(kind, norm)``; no two of a kind share one, and none is an entity."""
    drawn = materialise(found.withColumn("draw", F.lit(0)).withColumn("s", surrogate(F.col("kind"), F.col("norm"), F.col("draw"), key)), "drawn")
    real = drawn.select(F.col("kind").alias("_k"), F.col("norm").alias("_n"))
    for _ in range(DRAWS):
        first = Window.partitionBy("kind", "s").orderBy("draw", "norm")
        checked = drawn.withColumn("_rank", F.row_number().over(first)).join(
            real, (F.col("kind") == F.col("_k")) & (F.col("s") == F.col("_n")), "left"
        )
        kept = (F.col("kind") == "initial") | ((F.col("kind") == "given") & _is_listed(F.col("norm")))
        again = ~kept & ((F.col("_rank") > 1) | F.col("_n").isNotNull())
        checked = checked.select("kind", "norm", "draw", "s", again.alias("again"))
        if checked.where("again").isEmpty():
            return drawn.select("kind", "norm", "s")
        drawn = materialise(_redrawn(checked, key), "drawn")
    raise RuntimeError(f"surrogates still collide after {DRAWS} draws")


def _redrawn(checked: DataFrame, key: str) -> DataFrame:
    moved = checked.withColumn("draw", F.when(F.col("again"), F.col("draw") + 1).otherwise(F.col("draw")))
    new = F.when(F.col("again"), surrogate(F.col("kind"), F.col("norm"), F.col("draw"), key)).otherwise(F.col("s"))
    return moved.withColumn("s", new).drop("again")


def replace_personal_data(docs: DataFrame, text_col: str = "text", key: str = "surrogates", count_out: str = "n_entities") -> DataFrame:
    """``docs`` with surrogates in the text, and how many mentions were replaced.

    A null text stays null, a text without entities stays as it is.  Rows need no id, and repeated rows are treated alike.
    An existing column named ``count_out`` is replaced; other columns are kept.
    """
    kept = [c for c in docs.columns if c != count_out]
    tokens_, known_, hash_ = free([*kept, count_out], "_tokens", "_known", "_hk")
    text = F.col(f"`{text_col}`").cast("string")
    hint = F.coalesce(text.rlike(HINT), F.lit(False))
    # The patterns are the dear part: texts are searched once, and kept with what was found.
    tokens = F.when(hint, F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    searched = materialise(docs.select(*[F.col(f"`{c}`") for c in kept], tokens.alias(tokens_)), "tokens")
    keyed = searched.select(F.xxhash64(text).alias("_h"), F.explode(F.array_distinct(F.col(tokens_))).alias("t"))
    mentions = keyed.select("_h", F.explode(entities(F.col("t"))).alias("e")).select("_h", "e.kind", "e.norm").distinct()
    mentions = materialise(mentions, "mentions")
    known = draw_surrogates(mentions.select("kind", "norm").distinct(), key)
    by_text = mentions.join(known, ["kind", "norm"]).groupBy("_h").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "norm"), "s"))).alias(known_)
    )
    # Splitting by the pattern gives what stands between the mentions.
    some = F.size(F.col(tokens_)) > 0
    joined = searched.where(some).join(by_text.withColumnRenamed("_h", hash_), F.xxhash64(text) == F.col(hash_), "left")
    joined = joined.withColumn(known_, F.coalesce(F.col(known_), F.create_map().cast("map<string,string>")))
    new = F.transform(F.col(tokens_), lambda t: rendered(t, F.col(known_)))
    between = F.split(text, PATTERN)
    whole = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    count = F.size(F.filter(F.col(tokens_), lambda t: kind_of(t).isNotNull()))
    changed = joined.select(*[whole.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept], count.cast("long").alias(count_out))
    same = searched.where(~some).drop(tokens_)
    return changed.union(same.withColumn(count_out, F.lit(0).cast("long")))
