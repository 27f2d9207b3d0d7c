"""Personal data: format-preserving pseudonyms by a keyed Feistel permutation.

A found value is validated (check digits, calendar, number plans), written as a number within its format's domain,
permuted there under the key, and written back with the separators it had. The permutation depends on kind and key
only, so equal values get equal pseudonyms in every document, and different ones stay different. Pseudonyms pass the
same validation. Values that are not valid stay as they are, as does all other text. Null text stays null, an empty one
empty; each row gives one row, whatever else it holds.

The key is the caller's, or the session's (KEY_SETTING). Where neither names one, a random key is made for the
application: values are linked within its run, and nobody can undo them afterwards.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import secrets
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evidentia.llm.common import alone, bounded_batches

ROUNDS = 10
#: The session setting that holds the key, as text.
KEY_SETTING = "spark.evidentia.pseudonyms.key"
_OWN_KEYS: dict[str, bytes] = {}


def session_key(spark: SparkSession) -> bytes:
    """The session's key, else this application's own random one."""
    if named := spark.conf.get(KEY_SETTING, None):
        return named.encode()
    return _OWN_KEYS.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


class Permutation:
    """Keyed permutation of the numbers below n: a balanced Feistel network, walked until it lands below n."""

    def __init__(self, key: bytes, kind: str, n: int):
        self.n = n
        self.half = max(1, -(-max(1, n - 1).bit_length() // 2))
        self.mask = (1 << self.half) - 1
        self.bytes = -(-self.half // 8)
        size = str(n).encode() if n.bit_length() < 8192 else n.to_bytes(2 * self.bytes + 1, "little")
        self.key = hashlib.blake2b(kind.encode() + b"\0" + size, key=hashlib.blake2b(key).digest(), digest_size=32).digest()

    def _round(self, k: int, right: int) -> int:
        out, block = b"", 0
        while len(out) < self.bytes:
            out += hashlib.blake2b(bytes([k]) + block.to_bytes(1 if block < 256 else 4, "little") + right.to_bytes(self.bytes, "little"), key=self.key, digest_size=min(64, self.bytes)).digest()
            block += 1
        return int.from_bytes(out[: self.bytes], "little") & self.mask

    def __call__(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for k in range(ROUNDS):
                left, right = right, left ^ self._round(k, right)
            x = left << self.half | right
            if x < self.n:
                return x

    def inverse(self, x: int) -> int:
        while True:
            left, right = x >> self.half, x & self.mask
            for k in range(ROUNDS - 1, -1, -1):
                left, right = right ^ self._round(k, left), left
            x = left << self.half | right
            if x < self.n:
                return x


def luhn_digit(digits: str) -> str:
    total = sum(d if k % 2 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits))))
    return str(-total % 10)


def iban_check(country: str, bban: str) -> str:
    number = "".join(str(int(c, 36)) for c in bban + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _relay(text: str, digits: str) -> str:
    """digits in the places of text's digits."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in text)


def _walk(permute: Permutation, x: int, valid: Callable[[int], bool]) -> int:
    """Next valid image: a permutation of the valid numbers."""
    x = permute(x)
    while not valid(x):
        x = permute(x)
    return x


class Pseudonyms:
    """Rewrites the values of texts; remembers what it has made, up to a bound."""

    KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")

    def __init__(self, key: bytes, remembered: int = 100_000):
        self.key, self.remembered = key, remembered
        self.made: dict[tuple[str, str], str | None] = {}
        self.permutations: dict[tuple[str, int], Permutation] = {}

    def permutation(self, kind: str, n: int) -> Permutation:
        if (kind, n) not in self.permutations:
            if len(self.permutations) >= self.remembered // 10:
                self.permutations.clear()
            self.permutations[kind, n] = Permutation(self.key, kind, n)
        return self.permutations[kind, n]

    def card(self, text: str) -> str | None:
        digits = re.sub(r"\D", "", text)
        if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
            return None
        body = digits[:-1]
        new = str(self.permutation("card", 10 ** len(body))(int(body))).zfill(len(body))
        return _relay(text, new + luhn_digit(new))

    def iban(self, text: str) -> str | None:
        dense = text.replace(" ", "").upper()
        country, check, bban = dense[:2], dense[2:4], dense[4:]
        if not 11 <= len(bban) <= 30 or iban_check(country, bban) != check:
            return None
        new = self._classes("iban" + country, bban)
        it = iter(country + iban_check(country, new) + new)
        return "".join(c if c == " " else next(it) for c in text)

    def ssn(self, text: str) -> str | None:
        def valid(x: int) -> bool:
            area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
            return area not in (0, 666) and area < 900 and group > 0 and serial > 0

        x = int(re.sub(r"\D", "", text))
        return _relay(text, f"{_walk(self.permutation('ssn', 10**9), x, valid):09d}") if valid(x) else None

    def phone(self, text: str) -> str | None:
        """National numbers of ten digits, alone or after 1: area and exchange begin with 2 to 9. Other numbers behind a plus keep their first two digits."""

        def valid(x: int) -> bool:
            return x // 10**9 >= 2 and x // 10**6 % 10 >= 2

        digits = re.sub(r"\D", "", text)
        if (len(digits) == 10 and text[0] != "+" or len(digits) == 11 and digits[0] == "1") and valid(int(digits[-10:])):
            return _relay(text, digits[:-10] + f"{_walk(self.permutation('nanp', 10**10), int(digits[-10:]), valid):010d}")
        if text[0] != "+" or not 8 <= len(digits) <= 15:
            return None
        rest = digits[2:]
        return _relay(text, digits[:2] + str(self.permutation("phone", 10 ** len(rest))(int(rest))).zfill(len(rest)))

    def ip(self, text: str) -> str | None:
        octets = [int(x) for x in text.split(".")]
        if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
            return None
        x = self.permutation("ip", 1 << 32)(int.from_bytes(bytes(octets), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    FIRST, LAST = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)

    def date(self, text: str) -> str | None:
        """Year first, or day first, or month first where only that gives a date; the pseudonym reads the same way.

        Month-first dates have a day above 12, and so have their pseudonyms: no two spellings of different days meet.
        """
        parts, marks = re.split(r"[-/.]", text), re.findall(r"[-/.]", text)
        for y, m, d in ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
            try:
                day = datetime.date(int(parts[y]), int(parts[m]), int(parts[d]))
            except ValueError:
                continue
            if not self.FIRST <= day <= self.LAST:
                return None
            permute = self.permutation("date", (self.LAST - self.FIRST).days + 1)
            said = lambda x: self.FIRST + datetime.timedelta(days=x)
            late = (y, m, d) == (2, 0, 1)
            new = said(_walk(permute, (day - self.FIRST).days, lambda x: not late or said(x).day > 12))
            out = [""] * 3
            out[y], out[m], out[d] = f"{new.year:04d}", f"{new.month:0{len(parts[m])}d}", f"{new.day:0{len(parts[d])}d}"
            return out[0] + marks[0] + out[1] + marks[1] + out[2]
        return None

    def _classes(self, kind: str, text: str) -> str:
        """Permuted among the texts with letters and digits of the same classes in the same places."""
        sets = [next((s for s in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in s), c) for c in text]
        x, n, sizes = 0, 1, []
        for at in range(0, len(text), _STEP):  # in steps, as long numbers are slow
            y, size = 0, 1
            for c, s in zip(text[at : at + _STEP], sets[at : at + _STEP], strict=True):
                y, size = y * len(s) + s.index(c), size * len(s)
            x, n = x * size + y, n * size
            sizes.append(size)
        x = self.permutation(kind, n)(x)
        out = []
        for k in range(len(sizes) - 1, -1, -1):
            x, y = divmod(x, sizes[k])
            for s in reversed(sets[k * _STEP : (k + 1) * _STEP]):
                y, c = divmod(y, len(s))
                out.append(s[c])
        return "".join(reversed(out))

    def email(self, text: str) -> str:
        local, _, domain = text.rpartition("@")
        return self._classes("email@" + domain.lower(), local) + "@" + domain

    def secret(self, text: str) -> str:
        return self._classes("secret", text)

    def replaced(self, kind: str, value: str) -> str | None:
        """The value's pseudonym; None where it is not valid."""
        if (kind, value) not in self.made:
            if len(self.made) >= self.remembered:
                self.made.clear()
            self.made[kind, value] = getattr(self, kind)(value)
        return self.made[kind, value]

    def rewrite(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with its pseudonyms, and how many of each kind."""
        found: dict[str, int] = {}
        if not _HINT.search(text):
            return text, found
        out, done, at = [], 0, 0
        while match := _VALUES.search(text, at):
            group = match.lastgroup
            kind = group.rstrip("_")
            for start, end in _card_spans(text, match) if kind == "card" else [match.span(group)]:
                new = self.replaced(kind, text[start:end])
                if new is not None:
                    found[kind] = found.get(kind, 0) + 1
                    out += [text[done:start], new]
                    done = at = end
                    break
            else:  # what follows its first word may still hold a value
                at = _WORD.search(text, match.start()).end()
        return "".join([*out, text[done:]]), found


#: Nothing to find without one of these.
_HINT = re.compile(r"[0-9@]|AKIA|ASIA|(?i:password|passwd|pwd|secret|token|api_?key|access_?key)")
_WORD = re.compile(r"[^\W_]+")
#: Characters that `_classes` takes at a time.
_STEP = 512
_VALUES = re.compile(
    r"(?P<email>(?<![\w.+%-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}\b)"
    r"|(?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])"
    r"|(?i:\b(?:password|passwd|pwd|secret|token|api_?key|access_?key)\b\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9_+/=.-]{8,})"
    r"|\b(?:AKIA|ASIA)(?P<secret_>[A-Z0-9]{16})\b"
    r"|(?<![\w.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![\w]|\.[0-9])"
    r"|(?<![\w./-])(?P<date>[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{1,2}|[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4})(?![\w/-]|\.[0-9])"
    r"|(?<![\w-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])"
    r"|(?<![\w+])(?P<phone>\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?!\w|\.[0-9])"
    r"|(?<![\w.-])(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?!\w|-[A-Za-z_])"
)
#: How cards are written, the most usual first; digits that follow one (an expiry date, a code) are not part of it.
_CARDS = [
    re.compile(rf"(?:{x})(?!\w|-[A-Za-z_])")
    for x in ("[0-9]{4}(?:[ -][0-9]{4}){3}", "[0-9]{13,19}", "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}", "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}", "[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,3}", "[0-9]{6}[ -][0-9]{13}")
]


def _card_spans(text: str, match: re.Match) -> Iterator[tuple[int, int]]:
    """Where a card that begins with the match may end: as cards are written, then the longest run of digits."""
    for pattern in _CARDS:
        if found := pattern.match(text, match.start()):
            yield found.span()
    yield match.span("card")


def _rewritten(batches: Iterator[pa.RecordBatch], key: bytes) -> Iterator[pa.RecordBatch]:
    alone("pii")
    tool = Pseudonyms(key)
    for batch in batches:
        texts, counts, kinds = [], [], []
        for text in batch.column(1).to_pylist():
            new, found = (None, {}) if text is None else tool.rewrite(text)
            texts.append(new)
            counts.append(sum(found.values()))
            kinds.append(",".join(sorted(found)))
        columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["__row", "__text", "__n", "__kinds"])


def pseudonymise(docs: DataFrame, key: bytes | None = None, column: str = "text") -> DataFrame:
    """docs with its text rewritten, and `__n` (values replaced) and `__kinds` (their kinds, sorted, by commas).

    These two take the place of columns of their names.
    """
    bounded_batches(docs.sparkSession)
    key = session_key(docs.sparkSession) if key is None else key
    names = [c for c in docs.columns if c not in ("__n", "__kinds")]
    rest = [F.col(f"`{c}`") for c in names if c != column]
    slim = docs.select(F.struct(*(rest or [F.lit(0).alias("none")])).alias("__row"), F.col(column).cast("string").alias("__text"))
    schema = T.StructType([slim.schema[0], T.StructField("__text", T.StringType()), T.StructField("__n", T.LongType()), T.StructField("__kinds", T.StringType())])
    out = slim.mapInArrow(lambda b: _rewritten(b, key), schema)
    shown = [F.col("__text").alias(column) if c == column else F.col("__row").getField(c).alias(c) for c in names]
    return out.select(*shown, "__n", "__kinds")
