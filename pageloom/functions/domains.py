"""Registered domain of a host: the longest public suffix that fits, and one label more.

A rule is a suffix (``co.uk``), a wildcard (``*.ck``: any label below ck) or an exception (``!www.ck``). The longest
fitting rule wins, exceptions before all; a host without a rule has a suffix of one label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Public suffixes of two labels in countries that register below them, wildcards and exceptions.
BELOW = {
    "au": "asn com edu gov id net org", "bd": "", "br": "art blog com edu eco gov net org", "ck": "", "cn": "ac com edu gov net org", "hk": "com edu gov idv net org", "id": "ac co go or sch web",
    "il": "ac co gov k12 muni net org", "in": "ac co edu firm gen gov ind net nic org res", "jp": "ac ad co ed go gr lg ne or", "kr": "ac co go ne or pe re", "mx": "com edu gob net org",
    "my": "com edu gov name net org", "nz": "ac co geek govt iwi maori net org school", "pl": "com edu gov info net org waw", "sg": "com edu gov net org per", "th": "ac co go in mi net or",
    "tr": "av bel biz com edu gen gov info k12 name net org web", "tw": "club com edu game gov idv net org", "ua": "com edu gov in net org", "uk": "ac co gov ltd me net nhs org plc police sch",
    "za": "ac co edu gov law net nom org school web",
}
RULES = [f"{second}.{top}" for top, seconds in BELOW.items() for second in seconds.split()]
RULES += ["*.bd", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp", "*.yokohama.jp", "!city.yokohama.jp"]
ADDRESS = r"^[0-9.]+$|:"


def parted(rules: list[str]) -> tuple[set[str], set[str], set[str]]:
    """Suffixes, bases of wildcards, exceptions."""
    plain = {r for r in rules if r[0] not in "*!"}
    return plain, {r[2:] for r in rules if r.startswith("*.")}, {r[1:] for r in rules if r.startswith("!")}


def domain_of_host(host: Column, rules: list[str] = RULES) -> Column:
    """Registered domain by a list of rules; a host that is a suffix itself, or an address, stays whole.

    The host is bound once, so that a long expression for it is not repeated with every rule.
    """
    plain, wild, but = parted(rules)
    most = max(r.count(".") + 1 for r in rules)

    def one_of(c: Column, names: set[str], labels: int) -> list[Column]:
        found = sorted(n for n in names if n.count(".") + 1 == labels)
        return [c.isin(found)] if found else []

    def domain(h: Column) -> Column:
        def last(n: int) -> Column:
            return F.substring_index(h, ".", -n)

        labels = F.length(h) - F.length(F.replace(h, F.lit("."))) + 1
        choice = F.when(h.rlike(ADDRESS), h)
        for n in range(most, 0, -1):  # an exception says that its own name is registered
            for hit in one_of(last(n), but, n):
                choice = choice.when(hit, last(n))
        for n in range(most, 1, -1):
            for hit in one_of(last(n), plain, n) + one_of(last(n - 1), wild, n - 1):
                choice = choice.when(hit & (labels >= n), last(n + 1))
        return choice.otherwise(last(2))

    return F.transform(F.array(host), domain)[0]


def registered_domains(hosts: DataFrame, rules: DataFrame, host: str = "host", rule: str = "rule") -> DataFrame:
    """(host, domain) of the different hosts by a table of rules of any size, in lower case."""
    own = hosts.select(F.lower(F.col(host)).alias("host")).where("host is not null").distinct()
    parts = own.selectExpr("host", "split(host, '[.]') AS l").selectExpr("host", "l", "explode(sequence(1, size(l))) AS n")
    ends = parts.selectExpr("host", "l", "n", "array_join(slice(l, size(l) - n + 1, n), '.') AS suffix")
    r = F.lower(F.col(rule))
    # what a rule fits, and how many labels more than that the registered domain has
    known = rules.select(
        F.regexp_replace(r, r"^(\*[.]|!)", "").alias("suffix"), F.when(r.startswith("!"), 0).when(r.startswith("*."), 2).otherwise(1).alias("more")
    ).distinct()
    fits = ends.join(known, "suffix").where("size(l) >= n + more - 1")
    # an exception is longer than any suffix and registers itself
    best = fits.groupBy("host").agg(F.max(F.struct((F.col("more") == 0).alias("but"), (F.col("n") + F.col("more")).alias("labels"))).alias("b"))
    labels = "least(size(split(h.host, '[.]')), coalesce(b.labels, 2))"
    return own.alias("h").join(best, "host", "left").selectExpr("host", f"if(host rlike '{ADDRESS}', host, substring_index(host, '.', -{labels.replace('h.host', 'host')})) AS domain")
