"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose candidate spans: of the base kinds (email, ip, card, phone), and of others: secrets, bank accounts, names after a title,
street addresses, and email addresses, phone numbers and IP addresses that are written in other ways. Labelers vote on a candidate (1: personal data,
-1: not, 0: no opinion): the strict pattern with its checks, a gazetteer (endings, prefixes, country codes, given names), the
words before it, and its shape; gazetteers and words are those of English, German, French and Spanish. Votes are counted per
candidate pattern over all documents; from these counts, whose number is bounded by patterns and votes, expectation-maximisation
estimates how reliable each labeler is, and a logistic span classifier is trained on the posteriors; it also sees a candidate's length, its share of digits and the signs around
it. A candidate is a span
if it is of a base kind and its strict pattern holds (base spans always stay), or if the classifier accepts it.

Base spans are matches of the kind's pattern, leftmost and without overlap, that pass its checks; a failing match is dropped.
Patterns are written with possessive runs and look-behinds that change no match but keep long runs linear.

Offsets count code points; ends are exclusive. Results for edge cases: a null text counts as empty and has no spans (masked, it stays null); overlaps between
kinds all stay, but a proposed span that overlaps a base span is dropped. A text of any length is read whole, in time proportional to its length and matches. Rows are independent but for the
reliabilities, so rows that repeat an id or text get equal spans; without any candidate, no classifier is needed; an empty table gives an empty one. Other
columns are ignored by pii_digests(), and kept by mask_documents(), whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from math import exp, log
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.llm.common import free_names, stored, table

BASE = ("email", "ip", "card", "phone")
#: Candidate patterns; what a proposed span of each is called.
KINDS = (*BASE, "secret", "account", "name", "address", "odd_email", "odd_phone", "odd_ip")
LABEL = {k: k.removeprefix("odd_") for k in KINDS}
LABELERS = ("pattern", "gazetteer", "context", "shape")
#: Traits of a candidate, and the values that each can have.
TRAITS, TRAIT_VALUES = 4, 3
#: Each labeler's chance to vote right as it is believed before any votes, and how many votes that belief weighs.
TRUST, WEIGHT = (0.97, 0.8, 0.8, 0.8), (200, 10, 10, 10)
#: A proposed span needs this probability.
ACCEPT = 0.8
#: Matches, and characters of text, that are handled in one go.
BLOCK, TEXT_BLOCK = 256, 1024
BEFORE = 32  # characters before a candidate that the context labeler sees

# The candidate patterns, and a cheap condition that any match meets.
MATCH = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+/-])(?=[0-9_+/-]*+[A-Za-z])(?=[A-Za-z_+/-]*+[0-9])[A-Za-z0-9_+/-]{16,}+(?![@.][A-Za-z0-9])",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?=[DFHMPS])(?<![\p{L}.])(?:(?:Mr|Mrs|Ms|Dr|Prof|M|Mme|Mlle|Sr|Sra|Srta|Hr|Fr)\.|Mister|Miss|Doctor|Herrn?|Frau|Doktor|Monsieur|Madame|Mademoiselle|Docteur|Se\x{f1}ora?|Se\x{f1}orita|Don|Do\x{f1}a)\x20\p{Lu}[\p{L}'-]{1,24}(?:\x20\p{Lu}[\p{L}'-]{1,24}){0,2}",
    "address": r"(?=[0-9\p{Lu}])(?<![\p{L}0-9])(?:[0-9]{1,5}\x20\p{Lu}\p{L}{1,24}(?:\x20\p{Lu}\p{L}{1,24})?\x20(?:Street|Avenue|Road|Lane|Drive|Boulevard|Square)(?!\p{L})|\p{Lu}\p{L}{1,24}(?:stra\x{df}e|strasse|weg|platz|gasse|allee)(?!\p{L})(?:\x20[0-9]{1,4}[a-z]?(?![\p{L}0-9]))?|[0-9]{1,5},?\x20(?:rue|avenue|boulevard|place|chemin)\x20(?:(?:de|du|des|la)\x20){0,2}\p{Lu}\p{L}{1,24}|(?:Calle|Avenida|Plaza|Paseo)\x20(?:(?:de|del|la)\x20){0,2}\p{Lu}\p{L}{1,24}(?:,?\x20[0-9]{1,4})?)",
    "odd_email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:[\[({<]\x20?(?:at|AT|arroba|\x{e4}t)\x20?[\])}>]|(?<=\x20)(?:at|AT|arroba)(?=\x20))\x20?[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({<]\x20?(?:dot|DOT|punkt|point|punto)\x20?[\])}>]\x20?|\x20(?:dot|DOT|punkt|point|punto)\x20|\.)[A-Za-z0-9-]{2,63}){1,4}",
    "odd_phone": r"(?<![A-Za-z0-9+./-])(?<![0-9][\x20)])(?:\(0?[0-9]{2,4}\)|0?[0-9]{2,4})[\x20./-][0-9]{2,4}(?:[\x20./-]?[0-9]{2,4}){1,3}(?![\x20./-]?[0-9])(?![A-Za-z])",
    "odd_ip": r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::(?:[0-9A-Fa-f]{1,4}:){0,5})?[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])",
}
# What a text must match, or one of what it must contain, to hold any match at all.
MAYBE = {
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){13}", "phone": r"\+[0-9][\x20().0-9-]", "secret": r"[A-Za-z0-9_+/-]{16}", "account": r"[A-Z]{2}[0-9]{2}",
    "odd_email": r"[\[({<]\x20?(?:at|AT|arroba|\x{e4}t)\x20?[\])}>]|\x20(?:at|AT|arroba)\x20[A-Za-z0-9-]++(?:\.[A-Za-z]|\x20(?:dot|DOT|punkt|point|punto)\x20|\x20?[\[({<])", "odd_phone": r"[0-9][\x20)./-]++[0-9]", "odd_ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{0,4}:",
}
#: Kinds without a match where a text has no digit.
DIGITS = frozenset(("ip", "card", "phone", "secret", "account", "odd_phone"))
HOLDS = {
    "email": "@",
    "name": "Mr.|Mrs.|Ms.|Dr.|Prof.|M.|Mme.|Mlle.|Sr.|Sra.|Srta.|Hr.|Fr.|Mister |Miss |Doctor |Herr|Frau |Doktor |Monsieur |Madame |Mademoiselle |Docteur |Se\xf1or|Don |Do\xf1a ",
    "address": "Street|Avenue|Road|Lane|Drive|Boulevard|Square|stra\xdfe|strasse|weg|platz|gasse|allee| rue | avenue | boulevard | place | chemin |Calle|Avenida|Plaza|Paseo",
}
# Gazetteers and context words, in four languages.
ENDINGS = "com|net|org|edu|gov|io|info|biz|co|uk|de|fr|es|it|nl|eu|ch|at|ca|us|au"
ISSUERS = "4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30|36|38"
COUNTRIES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
KEYS = "AKIA|ASIA|ghp_|gho_|sk-|pk-|xox[abp]-|AIza|glpat-"
BANKS = "AD|AT|BE|BG|CH|CY|CZ|DE|DK|EE|ES|FI|FR|GB|GR|HR|HU|IE|IS|IT|LI|LT|LU|LV|MC|MT|NL|NO|PL|PT|RO|SE|SI|SK|SM"
GIVEN = (
    "James|John|Robert|Michael|William|David|Richard|Joseph|Thomas|Mary|Patricia|Jennifer|Linda|Elizabeth|Susan|Sarah|Karen|Emma|Anna|Alice|Hans|Peter|Klaus|J\\x{fc}rgen|Stefan|Andreas|Wolfgang|Ursula|Monika|Petra|Sabine|Heike|Julia"
    "|Jean|Pierre|Michel|Philippe|Alain|Luc|Marie|Nathalie|Isabelle|Sylvie|Catherine|Camille|Jos\\x{e9}|Antonio|Manuel|Francisco|Juan|Carlos|Javier|Mar\\x{ed}a|Carmen|Ana|Isabel|Laura|Luc\\x{ed}a|Pilar"
)
TITLES = "Mr|Mrs|Ms|Dr|Prof|Mme|Mlle|Sra|Srta|Mister|Herrn?|Frau|Monsieur|Madame|Mademoiselle|Se\\x{f1}ora?|Se\\x{f1}orita"
WORDS = {
    "email": "mail|contact|write to|kontakt|schreib\\p{L}*|courriel|\\p{L}*cri\\p{L}*|correo|escrib\\p{L}*", "ip": "ip|host|server|address|adresse|rechner|serveur|servidor|direcci\\x{f3}n",
    "card": "card|visa|credit|payment|karte|zahlung|carte|paiement|tarjeta|pago", "phone": "phone|tel|call|mobile|fax|telefon|handy|anruf|t\\x{e9}l\\x{e9}phone|portable|appel\\p{L}*|tel\\x{e9}fono|m\\x{f3}vil|llam\\p{L}*",
    "secret": "token|passw(?:or)?d|pwd|secret|key|credential|schl\\x{fc}ssel|kennwort|passwort|cl\\x{e9}|mot de passe|jeton|clave|contrase\\x{f1}a",
    "account": "iban|account|bank|transfer|konto|bankverbindung|compte|virement|cuenta", "name": "name|called|signed|from|dear|hei\\x{df}e|liebe[r]?|von|appelle|cher|ch\\x{e8}re|llamo|estimad[oa]",
    "address": "address|live[s]? at|street|adresse|wohn[te]\\p{L}*|anschrift|habite|domicile|direcci\\x{f3}n|viv[eo] en|domicilio",
}
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]?)(?<=[0-9])"


def _split(df: DataFrame, text: Column, pieces: dict[str, str], matches: dict[str, str]) -> DataFrame:
    """Adds for each kind the pieces between matches and the matches, null where there are none for sure. What a text lacks is found out once, cheap signs first."""
    digit, *flags = free_names(df, "digit", *(f"maybe_{k}" for k in KINDS))
    flag = dict(zip(KINDS, flags))
    sign = lambda k: text.rlike(MAYBE[k]) if k in MAYBE else reduce(or_, map(text.contains, HOLDS[k].split("|")))
    gate = lambda k: F.col(digit) & sign(k) if k in DIGITS else sign(k)
    known = df.withColumn(digit, text.rlike("[0-9]")).select("*", *(gate(k).alias(flag[k]) for k in KINDS))
    found = lambda k, c: F.when(F.col(flag[k]), c)
    return known.select(*df.columns, *(c for k in KINDS for c in (found(k, F.split(text, MATCH[k], -1)).alias(pieces[k]), found(k, F.regexp_extract_all(text, F.lit(MATCH[k]), F.lit(0))).alias(matches[k]))))


def _running(df: DataFrame, array: str, name: str, value: Callable[[Column], Column], zero: Column, plus: Callable[[Column, Column], Column]) -> DataFrame:
    """Adds ``name``: for each element of ``array`` the sum (by ``plus``) of ``value`` over all elements before it. Sums are carried from block to block, so no long array is
    built by appending, and a text's matches take time in proportion."""
    (blocks,) = free_names(df, "blocks")
    starts = F.when(F.size(array) > 0, F.sequence(F.lit(0), F.size(array) - 1, F.lit(BLOCK))).otherwise(F.array().cast("array<int>"))
    cut = df.withColumn(blocks, F.transform(starts, lambda at: F.transform(F.slice(array, at + 1, BLOCK), value)))
    grown = lambda acc, x: F.concat(acc, F.array(plus(F.element_at(acc, -1), x)))
    carried = F.aggregate(blocks, F.array(zero), lambda acc, b: grown(acc, F.aggregate(b, zero, plus)))
    inside = F.zip_with(blocks, F.slice(carried, F.lit(1), F.size(blocks)), lambda b, c: F.slice(F.aggregate(b, F.array(c), grown), F.lit(1), F.size(b)))
    return cut.withColumn(name, F.flatten(inside)).drop(blocks)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check; from the right, every second digit is doubled."""
    n = F.length(digits)
    value = lambda i: F.substring(digits, n - i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 0, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + part(i)) % 10 == 0


def _mod97(account: Column) -> Column:
    """Whether a bank account's check digits hold: its first four signs go to the end, letters count from 10, and the number leaves 1."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    sign = lambda i: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(turned, i, F.lit(1))) - 1
    step = lambda acc, i: (acc * F.when(sign(i) > 9, 100).otherwise(10) + sign(i)) % 97
    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    """Whether a match passes the checks of its kind."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(f"^{BYTE}(?:\\.{BYTE}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind in ("phone", "odd_phone"):
        return F.length(digits).between(9 if kind == "odd_phone" else 10, 15)
    if kind == "account":
        return _mod97(F.regexp_replace(m, " ", ""))
    if kind == "name":
        return m.rlike(f"^(?:{TITLES})\\b")
    if kind == "address":
        return m.rlike("[0-9]")
    if kind == "odd_email":
        return m.rlike(r"[\[({<]") & m.rlike(f"(?i)[^A-Za-z0-9](?:{ENDINGS})$")
    if kind == "odd_ip":
        return m.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | (m.contains("::") & m.rlike("[0-9]") & m.rlike("[A-Fa-f]"))
    return m.rlike("^(?:AKIA|ASIA)[A-Z0-9]{16}$|^[0-9a-f]{18,64}$|^gh[po]_[A-Za-z0-9]{36}$")


def _traits(x: Column) -> list[Column]:
    """What the classifier sees beside the votes, in 0 to 2 each: length, share of digits, the signs before and after."""
    m = x["match"]
    n = F.length(m)
    steps = lambda c, a, b: F.when(c < a, 0).when(c < b, 1).otherwise(2)
    near = lambda c: F.when(c.rlike(r"[\p{L}0-9]"), 0).when(c.rlike(r"[\x20\x09-\x0D]") | (c == ""), 1).otherwise(2)
    return [steps(n, 12, 24), steps(F.length(F.regexp_replace(m, "[^0-9]", "")) * 100 / n, 1, 50), near(F.right(x["before"], F.lit(1))), near(x["after"])]


def _votes(kind: str, x: Column) -> list[Column]:
    m = x["match"]
    vote = lambda yes, no=0: F.when(yes, 1).otherwise(no)
    digits = F.regexp_replace(m, "[^0-9]", "")
    gazetteer = {
        "email": vote(m.rlike(f"(?i)\\.(?:{ENDINGS})$")), "ip": F.when(m.rlike(r"^0*(?:0|127|255)\."), -1).otherwise(0), "card": vote(digits.rlike(f"^(?:{ISSUERS})"), -1),
        "phone": vote(digits.rlike(f"^(?:{COUNTRIES})")), "secret": vote(m.rlike(f"^(?:{KEYS})")), "account": vote(m.rlike(f"^(?:{BANKS})"), -1), "name": F.when(m.rlike(f"\\b(?:{GIVEN})\\b"), 1).when(_valid(kind, m), 0).otherwise(-1),
        "address": vote(m.rlike(r"(?:Street|Avenue|Road|stra\x{df}e|strasse)\b|\brue\b|^Calle")), "odd_email": vote(m.rlike(f"(?i)[^A-Za-z0-9](?:{ENDINGS})$"), -1),
        "odd_phone": vote(m.rlike(r"^\(?0"), 0), "odd_ip": F.when(m.rlike("^(?i:fe80|::1|0+:0+)"), -1).otherwise(0),
    }
    shape = {
        "email": vote(~m.contains("..") & (F.instr(m, "@") <= 65), -1), "ip": vote(~m.rlike(r"(?:^|\.)0[0-9]"), -1), "card": vote(F.length(digits).isin(15, 16)),
        "phone": vote(m.rlike(r"[\x20().-]")), "secret": vote(F.length(digits) * 5 >= F.length(m), -1), "account": vote(F.length(F.regexp_replace(m, " ", "")).between(15, 34), -1),
        "name": vote(m.rlike(r"\p{Ll}(?:$|\x20\p{Lu}\p{Ll}+)*$") & ~m.rlike(r"\p{Lu}{3}"), -1), "address": vote(~m.rlike("[0-9]{5}")), "odd_email": vote(~m.rlike("(?:^|[^A-Za-z])(?:AT|DOT)(?:$|[^A-Za-z])") & ~m.contains(".."), -1),
        "odd_phone": vote(F.length(F.regexp_replace(m, "[^/.]", "")) != 2, -1), "odd_ip": vote(F.length(F.regexp_replace(m, "[^:]", "")) >= 3, -1),
    }
    words = WORDS[LABEL[kind]]
    return [F.when(_valid(kind, m), 1).otherwise(-1), gazetteer[kind], vote(x["before"].rlike(f"(?iu)\\b(?:{words})[^\\p{{L}}0-9]{{0,4}}(?:is|no|ist|est|es|=|:)?[^\\p{{L}}0-9+]{{0,4}}$")), shape[kind]]


def candidates(df: DataFrame, text_col: str, found_col: str) -> DataFrame:
    """Adds array<struct<start, rank, stop, kind, votes array<int>, traits array<int>>> of every candidate, by start and rank (the pattern's number). A proposed span that overlaps a
    valid base span isn't one: base spans that begin up to it are known by their largest end, later ones by the next start."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    every, offsets, at, back, ends, nexts, *names = free_names(df, "every", "offsets", "at", "back", "ends", "nexts", *(f"{what}_{k}" for k in KINDS for what in ("pieces", "matches")))
    pieces, matches = dict(zip(KINDS, names[::2])), dict(zip(KINDS, names[1::2]))
    split = _split(df, text, pieces, matches)

    def of(k: str) -> Column:
        n = F.size(matches[k])
        pairs = F.zip_with(F.arrays_zip(F.slice(pieces[k], F.lit(1), n).alias("p"), F.slice(pieces[k], F.lit(2), n).alias("q")), F.col(matches[k]), lambda p, m: F.struct(
            F.lit(KINDS.index(k)).alias("rank"), F.length(p["p"]).alias("gap"), m.alias("match"), F.right(p["p"], F.lit(BEFORE)).alias("before"), F.left(p["q"], F.lit(1)).alias("after")))
        return F.when(n > 0, pairs).otherwise(F.array().cast("array<struct<rank: int, gap: int, match: string, before: string, after: string>>"))

    # all kinds in one array: a kind's places are counted from the sum of the kinds before it
    length = lambda k: F.when(F.size(matches[k]) > 0, F.length(text) - F.length(F.element_at(pieces[k], -1))).otherwise(0)
    sums = [F.lit(0)]
    for k in KINDS[:-1]:
        sums.append(sums[-1] + length(k))
    gathered = split.select(*df.columns, F.concat(*map(of, KINDS)).alias(every), F.array(*sums).alias(offsets))
    placed = _running(gathered, every, at, lambda x: x["gap"] + F.length(x["match"]), F.lit(0), lambda a, b: a + b)

    def candidate(x: Column, place: Column) -> Column:
        start = place - F.get(F.col(offsets), x["rank"]) + x["gap"]
        case = lambda of_kind: reduce(lambda c, i: c.when(x["rank"] == i, of_kind(KINDS[i])), range(1, len(KINDS)), F.when(x["rank"] == 0, of_kind(KINDS[0])))
        votes = case(lambda k: F.array(*(v.cast("int") for v in _votes(k, x))))
        return F.struct(start.alias("start"), x["rank"].alias("rank"), (start + F.length(x["match"])).alias("stop"), F.get(F.array(*map(F.lit, KINDS)), x["rank"]).alias("kind"), votes.alias("votes"), F.array(*(v.cast("int") for v in _traits(x))).alias("traits"))

    ordered = placed.select(*df.columns, F.array_sort(F.zip_with(every, at, candidate)).alias(every))
    valid = lambda x: (x["rank"] < len(BASE)) & (x["votes"][0] == 1)
    ordered = ordered.select(*df.columns, every, F.reverse(every).alias(back))
    ordered = _running(ordered, every, ends, lambda x: F.when(valid(x), x["stop"]).otherwise(0), F.lit(0), lambda a, b: F.greatest(a, b))
    ordered = _running(ordered, back, nexts, lambda x: F.when(valid(x), x["start"]).otherwise(1 << 30), F.lit(1 << 30), lambda a, b: F.least(a, b))
    near = F.arrays_zip(F.col(every).alias("c"), F.col(ends).alias("e"), F.reverse(nexts).alias("n"))
    clear = lambda z: (z["c"]["rank"] < len(BASE)) | ((z["e"] <= z["c"]["start"]) & (z["n"] >= z["c"]["stop"]))
    return ordered.select(*df.columns, F.transform(F.filter(near, clear), lambda z: z["c"]).alias(found_col))


def reliabilities(counts: dict[tuple[int, ...], int], steps: int = 50) -> tuple[float, list[float], dict[tuple[int, ...], float]]:
    """The share of personal data, each labeler's chance to vote right, and the posterior of each pattern of votes."""
    prior, right = 0.5, list(TRUST)
    post: dict[tuple[int, ...], float] = {}
    total = sum(counts.values())
    for _ in range(steps):
        for votes in counts:
            score = log(prior / (1 - prior)) + sum(v * log(r / (1 - r)) for v, r in zip(votes, right))
            post[votes] = 1 / (1 + exp(-max(-50, min(50, score))))
        prior = min(0.99, max(0.01, (sum(n * post[v] for v, n in counts.items()) + 10) / (total + 20)))
        for j in range(len(LABELERS)):
            said = sum(n for v, n in counts.items() if v[j])
            agreed = sum(n * (post[v] if v[j] > 0 else 1 - post[v]) for v, n in counts.items() if v[j])
            right[j] = min(0.99, max(0.51, (agreed + WEIGHT[j] * TRUST[j]) / (said + WEIGHT[j])))
    return prior, right, post


def features(votes: tuple[int, ...], traits: tuple[int, ...]) -> tuple[int, ...]:
    """The votes, and for each value that each trait can have whether it has it."""
    return (*votes, *(int(t == v) for t in traits for v in range(TRAIT_VALUES)))


def classifier(counts: dict[tuple[int, ...], int], post: dict[tuple[int, ...], float], steps: int = 400) -> list[float]:
    """Logistic weights (the first for the bias) on features, fitted to the posteriors of each."""
    total = sum(counts.values())
    rows = [(n / total, post[x], [(j, v) for j, v in enumerate((1, *x)) if v]) for x, n in counts.items()]
    w = [0.0] * (1 + len(next(iter(counts))))
    for _ in range(steps):
        grad = [0.001 * x for x in w]
        for share, wanted, x in rows:
            off = share * (1 / (1 + exp(-max(-50, min(50, sum(w[j] * v for j, v in x))))) - wanted)
            for j, v in x:
                grad[j] += off * v
        w = [a - 1.0 * g for a, g in zip(w, grad)]
    return w


def train(found: DataFrame) -> dict[str, list[float]]:
    """Weights of each kind that has candidates; only counts per kind, votes and traits reach the driver, whose number has a fixed bound."""
    x = found.select(F.explode("found").alias("x")).groupBy("x.kind", "x.votes", "x.traits").agg(F.count("*").alias("n")).collect()
    counts: dict[str, dict[tuple, int]] = {}
    for r in x:
        counts.setdefault(r["kind"], {})[tuple(r["votes"]), tuple(r["traits"])] = r["n"]
    out = {}
    for k, cells in sorted(counts.items()):
        by_votes: dict[tuple[int, ...], int] = {}
        for (votes, _), n in cells.items():
            by_votes[votes] = by_votes.get(votes, 0) + n
        post = reliabilities(by_votes)[2]
        out[k] = classifier({features(*c): n for c, n in cells.items()}, {features(*c): post[c[0]] for c in cells})
    return out


def accepted(found: Column, weights: dict[str, list[float]]) -> Column:
    """Base spans, and candidates that the classifier accepts, by the kind that each is called."""
    limit = log(ACCEPT / (1 - ACCEPT))
    base = lambda x: (x["rank"] < len(BASE)) & (x["votes"][0] == 1)
    n = len(LABELERS)

    def score(x: Column, w: list[float]) -> Column:
        votes = [x["votes"][j] * F.lit(c) for j, c in enumerate(w[1 : n + 1])]
        traits = [F.get(F.array(*map(F.lit, w[1 + n + t * TRAIT_VALUES :][:TRAIT_VALUES])), x["traits"][t]) for t in range(TRAITS)]
        return reduce(lambda a, b: a + b, [F.lit(w[0]), *votes, *traits])

    def keep(x: Column) -> Column:
        return reduce(or_, [base(x), *((x["kind"] == k) & (score(x, w) >= limit) for k, w in weights.items())])

    label = lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), F.regexp_replace(x["kind"], "^odd_", "").alias("kind"))
    return F.transform(F.filter(found, keep), label)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def pii_digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    found = stored(candidates(df.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")), "text", "found").select("key", "found"))
    weights = train(found)
    base = F.filter("found", lambda x: (x["rank"] < len(BASE)) & (x["votes"][0] == 1))
    out = found.select("key", base.alias("base"), accepted(F.col("found"), weights).alias("all"))

    def count(k: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    return out.select(F.col("key").alias(id_col), *map(count, BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def masked(df: DataFrame, text_col: str, spans_col: str) -> DataFrame:
    """df with [KIND] in place of each span of the text; of overlapping spans the first counts, and is extended over the others. The text is cut into blocks, so that a piece is
    found without going through all that is before it."""
    blocks, after, parts = free_names(df, "blocks", "after", "parts")
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = _running(df.withColumn(blocks, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))), spans_col, after, lambda x: x["stop"], F.lit(0), lambda a, b: F.greatest(a, b))

    def piece(begin: Column, end: Column) -> Column:
        """The pieces of blocks from begin to end."""
        of = lambda b: F.substring(F.get(blocks, b), F.greatest(begin - b * TEXT_BLOCK, F.lit(0)) + 1, F.least(end - b * TEXT_BLOCK, F.lit(TEXT_BLOCK)) - F.greatest(begin - b * TEXT_BLOCK, F.lit(0)))
        number = lambda c: F.floor(c / TEXT_BLOCK).cast("int")
        return F.when(end > begin, F.transform(F.sequence(number(begin), number(end - 1)), of)).otherwise(F.array().cast("array<string>"))

    fresh = F.filter(F.zip_with(spans_col, after, lambda x, a: F.struct(a.alias("after"), x["start"].alias("start"), x["kind"].alias("kind"))), lambda z: z["start"] >= z["after"])
    named = F.flatten(F.transform(fresh, lambda z: F.concat(piece(z["after"], z["start"]), F.array(F.concat(F.lit("["), F.upper(z["kind"]), F.lit("]"))))))
    tail = piece(F.coalesce(F.array_max(F.transform(spans_col, lambda x: x["stop"])), F.lit(0)), F.length(text))
    done = cut.withColumn(parts, F.concat(named, tail))
    return done.withColumn(text_col, F.when(F.size(spans_col) > 0, F.array_join(parts, "")).otherwise(F.col(text_col))).select(*df.columns)


def mask_documents(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows with personal data masked in the text; a null text stays null. Rows are written with their candidates once, for training and masking."""
    (name,) = free_names(df, "found")
    found = stored(candidates(df, text_col, name))
    spans = found.withColumn(name, accepted(F.col(name), train(found.select(F.col(name).alias("found")))))
    return masked(spans, text_col, name).select(*df.columns)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digests(table(spark, sf_dir, "documents"))
