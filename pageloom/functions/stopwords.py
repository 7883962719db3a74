"""Stop words used by paragraph classification and term tables."""

# Frequent function words per language.
STOP_WORDS: dict[str, tuple[str, ...]] = {
    "en": tuple(
        "a about above after again all also am an and any are as at be because been before being below between both but by "
        "can could did do does doing down during each few for from further had has have having he her here hers him his how "
        "i if in into is it its itself just me more most my no nor not now of off on once only or other our out over own same "
        "she should so some such than that the their them then there these they this those through to too under until up very "
        "was we were what when where which while who whom why will with would you your".split()
    ),
    "fr": tuple("au aux avec ce ces dans de des du elle en est et il je la le les leur lui mais ne nous on ou par pas pour que qui sa se ses son sur un une vous".split()),
    "de": tuple("aber als am an auch auf aus bei das dass dem den der des die ein eine einer er es für hat ich im in ist mit nicht noch sch sich sie sind und von war wie wir zu".split()),
    "es": tuple("al como con de del el en es esta la las lo los más me no nos o para pero por que se ser si sin su un una y".split()),
}


def stop_words(lang: str | None = None) -> tuple[str, ...]:
    """Words of one language, or of all of them."""
    if lang is not None:
        return STOP_WORDS[lang]
    return tuple(sorted({w for words in STOP_WORDS.values() for w in words}))
