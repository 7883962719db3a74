"""Suffix-rule stemmer for English words (Porter, "An algorithm for suffix stripping", 1980) as SQL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame

# The suffix rules of the published algorithm, the longest of a step first.
STEP_2 = {
    "ational": "ate", "ization": "ize", "iveness": "ive", "fulness": "ful", "ousness": "ous", "tional": "tion", "biliti": "ble", "entli": "ent", "ousli": "ous", "ation": "ate",
    "alism": "al", "aliti": "al", "iviti": "ive", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "ator": "ate", "eli": "e",
}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
STEP_4 = "ement ance ence able ible ment ant ent ion ism ate iti ous ive ize al er ic ou".split()


class Dialect:
    """How an engine cuts and replaces; both write patterns alike."""

    def __init__(self, every: str = "", group: str = "$1", ends: str = "endswith({w}, '{s}')"):
        self.every, self.group, self.ends_with = every, group, ends

    def replace(self, c: str, pattern: str, new: str) -> str:
        return f"regexp_replace({c}, '{pattern}', '{new}'{self.every})"

    def form(self, c: str) -> str:
        """The word as vowels (V) and consonants (C); a y behind a consonant is a vowel."""
        vowels = f"translate({self.replace(c, '([^aeiou])y', self.group + 'i')}, 'aeiou', 'VVVVV')"
        return self.replace(vowels, "[^V]", "C")

    def measure(self, c: str) -> str:
        """Number of runs of vowels that a run of consonants follows."""
        runs = self.replace(self.replace(self.form(c), "V+", "V"), "C+", "C")
        return f"((length({runs}) - length(replace({runs}, 'VC', ''))) / 2)"

    def short(self, c: str) -> str:
        """Ends in consonant, vowel, consonant, the last none of w, x, y."""
        return f"(right({self.form(c)}, 3) = 'CVC' and right({c}, 1) not in ('w', 'x', 'y'))"

    def double(self, c: str) -> str:
        return f"(length({c}) > 1 and right({c}, 1) = left(right({c}, 2), 1) and right({self.form(c)}, 1) = 'C')"

    def find(self, suffixes) -> str:
        """The first of the suffixes that the word ``w`` ends in, empty if none."""
        whens = " ".join(f"when {self.ends_with.format(w='w', s=s)} then '{s}'" for s in suffixes)
        return f"case {whens} else '' end"

    def steps(self) -> list[tuple[str, str]]:
        """For each step the suffix ``s`` of the word ``w``, and the new word from ``w``, ``s`` and what is before it, ``b``."""
        m, vowel = self.measure("b"), f"contains({self.form('b')}, 'V')"

        def swap(rules: dict[str, str]) -> tuple[str, str]:
            new = " ".join(f"when '{s}' then '{r}'" for s, r in rules.items())
            return self.find(rules), f"case when s <> '' and {m} > 0 then concat(b, case s {new} end) else w end"

        # the mark tells the next step that a suffix has gone
        past = f"case when s = 'eed' then case when {m} > 0 then concat(b, 'ee') else w end when s in ('ed', 'ing') and {vowel} then concat(b, '+') else w end"
        mended = (
            "case when s = '' then w when right(b, 2) in ('at', 'bl', 'iz') then concat(b, 'e') "
            f"when {self.double('b')} and right(b, 1) not in ('l', 's', 'z') then left(b, length(b) - 1) when {m} = 1 and {self.short('b')} then concat(b, 'e') else b end"
        )
        return [
            (self.find(["sses", "ies", "ss", "s"]), "case s when 'sses' then concat(b, 'ss') when 'ies' then concat(b, 'i') when 's' then b else w end"),
            (self.find(["eed", "ed", "ing"]), past),
            (self.find(["+"]), mended),
            (self.find(["y"]), f"case when s <> '' and {vowel} then concat(b, 'i') else w end"),
            swap(STEP_2),
            swap(STEP_3),
            (self.find(STEP_4), f"case when s <> '' and {m} > 1 and (s <> 'ion' or right(b, 1) in ('s', 't')) then b else w end"),
            (self.find(["e"]), f"case when s <> '' and ({m} > 1 or ({m} = 1 and not {self.short('b')})) then b else w end"),
            (self.find(["ll"]), f"case when s <> '' and {self.measure('w')} > 1 then left(w, length(w) - 1) else w end"),
        ]


SPARK = Dialect()
DUCKDB = Dialect(", 'g'", r"\1", "ends_with({w}, '{s}')")


def with_stem(words: DataFrame, column: str, name: str = "stem") -> DataFrame:
    """Add ``name``: the stem of a lower-case word. Words of one or two letters stay; other letters than a-z count as consonants."""
    kept = [f"`{c}`" for c in words.columns]
    out = words.selectExpr(*kept, f"`{column}` AS w")
    for found, new in SPARK.steps():
        out = out.selectExpr(*kept, "w", f"if(length(`{column}`) > 2, {found}, '') AS s").selectExpr(*kept, "w", "s", "left(w, length(w) - length(s)) AS b")
        out = out.selectExpr(*kept, f"{new} AS w")
    return out.withColumnRenamed("w", name)
