"""Deadlines: dates anchored to words that announce a deadline, their status, and how dates are shown."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, and the words that come before a deadline.
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")
ANNOUNCED = (
    r"(?:scadenz\w*|termine\s+(?:ultimo|perentorio|finale|di\s+presentazione|di\s+scadenza)|entro\s+e\s+non\s+oltre"
    r"|entro\s+(?:le\s+ore\s+[\d.:]+\s+)?(?:del\s+giorno\s+|del\s+|il\s+)|pena\s+(?:di\s+)?esclusione"
    r"|(?:presentazione|invio|inoltro|trasmissione)\s+(?:delle?\s+|dell['’]\s*)?(?:domand\w+|candidatur\w+|istanz\w+|offert\w+|manifestazion\w+)"
    r"|far\s+pervenire|dovranno\s+pervenire)"
)
SPAN = 130
_DATE = r"\b(\d{1,2})(?:[/.\-](\d{1,2})[/.\-]|\s+(" + "|".join(MONTHS) + r")\s+)(\d{4})\b"


def _windows(text: Column) -> Column:
    """The text after each announcement; taken in a lookahead, so that windows may overlap."""
    return F.regexp_extract_all(text, F.lit(rf"(?iUs){ANNOUNCED}(?=(.{{0,{SPAN}}}))"), F.lit(1))


def _first_date(window: Column) -> Column:
    """The first valid date of a window, day before month."""
    found = [F.regexp_extract_all(window, F.lit(rf"(?iU){_DATE}"), F.lit(i)) for i in (1, 2, 3, 4)]
    names = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, str(i + 1))])
    dates = F.transform(
        F.arrays_zip(found[0].alias("d"), found[1].alias("m"), found[2].alias("n"), found[3].alias("y")),
        lambda x: F.try_to_date(F.concat_ws("-", x["y"], F.when(x["m"] != "", x["m"]).otherwise(names[F.lower(x["n"])]), x["d"]), "yyyy-M-d"),
    )
    return F.get(F.filter(dates, lambda d: d.isNotNull()), F.lit(0))


def deadline(text: Column) -> Column:
    """The latest of the dates announced as a deadline; NULL where none is."""
    return F.array_max(F.transform(_windows(text), _first_date))


def status(due: Column, as_of: Column) -> Column:
    """aperto, scaduto or ignota on a day; the day of the deadline is still open."""
    return F.when(due.isNull(), "ignota").when(due >= as_of, "aperto").otherwise("scaduto")


def days_ago(at: Column, now: Column) -> Column:
    """oggi, ieri or so many days ago; '' for NULL."""
    n = F.floor((F.unix_timestamp(now) - F.unix_timestamp(at)) / 86400)
    return F.when(at.isNull(), "").when(n <= 0, "oggi").when(n == 1, "ieri").otherwise(F.concat(n.cast("string"), F.lit(" giorni fa")))


def shown(day: Column) -> Column:
    """A date as in '05 mar 2026'; a dash for NULL."""
    short = F.array(*[F.lit(m[:3]) for m in MONTHS])
    return F.when(day.isNull(), "—").otherwise(F.concat_ws(" ", F.date_format(day, "dd"), F.get(short, F.month(day) - 1), F.date_format(day, "yyyy")))
