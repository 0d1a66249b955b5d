"""Phonetic codes. Soundex is native; the others are rules tried at each place of a word.

A rule is a pattern for what stands there, with look-behind and look-ahead for its
surroundings, and what it gives. The first rule that fits is taken and its match is
consumed. Words are made large and stripped of all but letters first.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def soundex(word: Column) -> Column:
    """The built-in code of the letters; words with other letters than A to Z stay as they are."""
    letters = F.regexp_replace(F.upper(word), r"[^\p{L}]", "")
    return F.when(letters.rlike("[^A-Z]"), word).otherwise(F.soundex(letters))


def soundex_difference(a: Column, b: Column) -> Column:
    """How many of the four places agree."""
    x, y = soundex(a), soundex(b)
    return sum(((F.substring(x, i, 1) == F.substring(y, i, 1)).cast("int") for i in range(1, 5)), F.lit(0))


def letters(word: str, keep: str = "") -> str:
    s = unicodedata.normalize("NFD", word.replace("ß", "ss")) if not keep else word
    return "".join(c for c in s.upper() if "A" <= c <= "Z" or c in keep)


def walk(word: str, rules: list[tuple[re.Pattern, tuple[str, ...]]]) -> list[str]:
    """Joined outputs of the rules along a word, one string for each output of a rule; what no rule fits is passed over."""
    width = len(rules[0][1])
    out, at = [""] * width, 0
    while at < len(word):
        for pattern, gives in rules:
            m = pattern.match(word, at)
            if m:
                out = [o + g for o, g in zip(out, gives)]
                at = max(m.end(), at + 1)
                break
        else:
            at += 1
    return out


def rules_of(text: str, width: int = 1) -> list[tuple[re.Pattern, tuple[str, ...]]]:
    """Lines ``pattern output [output]``; a dash is no output, and a missing second output is the first."""
    out = []
    for line in text.strip().splitlines():
        pattern, *gives = line.split()
        gives = [g.replace("-", "") for g in gives]
        out.append((re.compile(pattern), tuple((gives * width)[:width])))
    return out


# The published rules of Cologne phonetics.
COLOGNE = rules_of(r"""
[AEIOUJY] 0
B 1
P(?!H) 1
P(?=H) 3
[DT](?=[CSZ]) 8
[DT] 2
[FVW] 3
[GKQ] 4
(?<![A-Z])C(?=[AHKLOQRUX]) 4
(?<=[SZ])C 8
(?<=[A-Z])C(?=[AHKOQUX]) 4
C 8
(?<=[CKQ])X 8
X 48
L 5
[MN] 6
R 7
[SZ] 8
H -
""")


def cologne(word: str) -> str:
    s = word.upper().translate(str.maketrans({"Ä": "A", "Ö": "O", "Ü": "U", "ß": "S"})).replace("SS", "S" if "ß" in word else "SS")
    code = walk(letters(s), COLOGNE)[0]
    code = re.sub(r"(.)\1+", r"\1", code)
    return code[:1] + code[1:].replace("0", "")


# The published rules of Metaphone; 0 stands for th.
METAPHONE = rules_of(r"""
^[GKP](?=N) -
^W(?=R) -
^A(?=E) -
^X S
^WH W
(?<=M)B$ -
([B-DF-HJ-NP-TV-Z])(?=\1) -
^[AEIOU] VOWEL
[AEIOU] -
B B
CIA X
(?<=S)CH K
CH X
(?<=S)C(?=[IEY]) -
C(?=[IEY]) S
C K
D(?=G[EIY]) J
D T
G(?=H(?:[^AEIOU]|$)) -
G(?=N(?:ED)?$) -
(?<=D)G(?=[EIY]) -
G(?=[IEY]) J
G K
(?<=[CSPTG])H -
H(?=[AEIOU]) H
H -
(?<=C)K -
K K
PH F
P P
Q K
SH X
SI[OA] X
S S
TI[OA] X
TH(?=M) T
TH 0
T(?=CH) -
T T
V F
[WY](?=[AEIOU]) SELF
[WY] -
X KS
Z S
[FJLMNR] SELF
""")


def metaphone(word: str, length: int = 4) -> str:
    s, out, at = letters(word), "", 0
    while at < len(s) and len(out) < length:
        for pattern, gives in METAPHONE:
            m = pattern.match(s, at)
            if m and (m.end() > at):
                out += s[at] if gives[0] in ("SELF", "VOWEL") else gives[0]
                at = m.end()
                break
        else:
            at += 1
    return out[:length]


# Rules after the published Double Metaphone, most special first; two outputs where readings differ.
DOUBLE = rules_of(r"""
^[GKP](?=N) -
^P(?=S) -
^W(?=R) -
^X S
^[AEIOUY] A
[AEIOUY] -
BB? P
^CAESAR SSR
(?<=[^AEIOUY]A)CH(?=[^IE]) K
^CH(?=ARAC|ARIS|EM|IA|OR(?!E)|YM) K
(?<=MC)H K
(?<=OR)CH(?=[EI](?:D|S)) K
(?<=AR)CH(?=IT|ES) K
CH(?=T|S) K
^CH(?=[LRNMBHFVW]) K
CH X K
(?<!WI)CZ S X
CIA X
(?<!^M)CC(?=[IEH](?!HU)) KS X
CC K
C[KGQ] K
CI(?=[OEA]) S X
C(?=[IEY]) S
C(?:[\s]?[CGQ]) K
C K
DG(?=[IEY]) J
DG TK
D[TD] T
D T
FF? F
(?<=[^AEIOUY])GH K
^GHI J
^GH K
(?<=[BHD][AEIOUY])GH -
(?<=[BHD][AEIOUY][AEIOUY])GH -
(?<=[CGLRT]U)GH F
(?<=I)GH -
GH K
(?<=^[AEIOUY])GN(?!EY|Y) KN N
GN(?=EY) KN
GN N KN
GLI KL L
^G(?=Y|ES|EP|EB|EL|EY|IB|IL|IN|IE|EI|ER) K J
G(?=ER)(?<!DANG)(?<!RANG)(?<!MANG) K J
GG(?=I|E) J K
G(?=[EIY]) J K
GG? K
H(?<=^H)(?=[AEIOUY]) H
(?<=[AEIOUY])H(?=[AEIOUY]) H
H -
^JOSE HS
^J J A
(?<=[AEIOUY])J(?=[AO]) J H
J$ J -
J(?=[LTKSNMBZ]) -
JJ? J
KK? K
L(?:L(?=O$|A$|OS$|AS$|E$)) L -
LL? L
(?<=U)MB(?=$|ER) M
MM? M
NN? N
PH F
P[PB]? P
QQ? K
(?<=IE)R$ - R
RR? R
(?<=[IY])S(?=L) -
^SUGAR XKR SKR
SH(?=EIM|OEK|OLM|OLZ) S
SH X
SI[OA] S X
^S(?=[MNLW]) S X
SZ S X
SCH(?=ER|EN) X SK
SCH(?=OO|UY|ED|EM) SK
^SCH(?=[^AEIOUYW]) X S
SCH X
SC(?=[IEY]) S
SC SK
(?<=[AO]I)S$ - S
S[SZ]? S
TION XN
TIA X
TCH X
T(?:H)(?=OM|AM) T
TTH 0 T
TH 0 T
T[TD]? T
VV? F
WR R
^W(?=[AEIOUY]) A F
^WH A
(?<=[AEIOUY])W$ - F
W(?=SKI|SKY) - F
WICZ TS FX
WITZ TS FX
W -
(?<=IAU|EAU)X$ -
(?<=AU|OU)X$ -
X[CX]? KS
ZH J
Z(?=ZO|ZI|ZA) S TS
(?<=[^T])Z S TS
ZZ? S
""", 2)  # fmt: skip


def double_metaphone(word: str, length: int = 4) -> tuple[str, str]:
    s = letters(word.replace("ç", "s").replace("ñ", "n"))
    first, second = walk(s, DOUBLE)
    return first[:length], second[:length]


def codes(word: str) -> Column:
    """A struct of the Cologne, Metaphone and both Double Metaphone codes of a column, by one vectorised function."""

    def run(s: pd.Series) -> pd.DataFrame:
        w = s.fillna("")
        d = w.map(double_metaphone)
        return pd.DataFrame({"cologne": w.map(cologne), "metaphone": w.map(metaphone), "double_primary": d.map(lambda x: x[0]), "double_alternate": d.map(lambda x: x[1])})

    return F.pandas_udf(run, "cologne string, metaphone string, double_primary string, double_alternate string")(F.col(word))


def equal_codes(a: str, b: str, encoder: str = "cologne") -> Column:
    f = {"cologne": cologne, "metaphone": metaphone, "double": lambda w: double_metaphone(w)[0]}[encoder]

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return x.fillna("").map(f) == y.fillna("").map(f)

    return F.pandas_udf(run, "boolean")(F.col(a), F.col(b))
