"""Rule packs: what a scorer looks for, as data."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RulePack:
    """Patterns by tier, with the weights of a match anywhere and of a match in the title on top."""

    strong: tuple[str, ...] = ()
    medium: tuple[str, ...] = ()
    weak: tuple[str, ...] = ()
    guards: tuple[str, ...] = ()
    vetoes: tuple[str, ...] = ()
    categories: tuple[tuple[str, tuple[str, ...]], ...] = ()
    otherwise: str = "generico"
    strong_weight: tuple[float, float] = (0.5, 0.25)
    medium_weight: tuple[float, float] = (0.3, 0.1)
    weak_weight: tuple[float, int] = (0.08, 4)
    guard_weight: float = 0.35
    #: A text without this pattern can't match any rule of the tier; spares the tier's patterns.
    hints: dict[str, str] = field(default_factory=dict)


# The patterns for calls for external experts, over lower-case text without accents.
EXPERTS = RulePack(
    strong=(
        r"espert[oi] estern[oi]",
        r"espert[oi] madrelingua",
        r"selezione .{0,40}?espert[oi]",
        r"individuazione .{0,40}?espert[oi]",
        r"reclutamento .{0,40}?espert[oi]",
        r"reperimento .{0,40}?espert[oi]",
        r"conferimento .{0,40}?incarico .{0,40}?espert",
        r"avviso .{0,60}?espert[oi] estern",
        r"avviso pubblico .{0,60}?espert[oi]",
        r"incarico .{0,30}?espert[oi] estern",
        r"art\.?\s*7\s*,?\s*comma\s*6",
        r"collaboraz\w* estern\w* .{0,40}?espert",
        r"personale estern[oi] .{0,30}?espert",
        r"prestazione d'?opera .{0,40}?espert",
    ),
    medium=(
        r"selezione .{0,25}?psicolog",
        r"avviso .{0,30}?psicolog",
        r"sportello (di )?ascolto",
        r"selezione .{0,25}?madrelingua",
        r"selezione .{0,25}?formatore",
        r"formatore estern",
        r"collaudatore",
        r"progettista",
        r"\brspp\b",
        r"medico competente",
        r"\bdpo\b|\brpd\b",
        r"animatore digitale",
    ),
    weak=(
        r"avviso pubblico",
        r"avviso di selezione",
        r"\bband[oi]\b",
        r"manifestazione di interesse",
        r"incarico di",
        r"prestazione d'?opera",
        r"contratto di collaborazione",
        r"\bco\.?co\.?co\b",
        r"incarico professionale",
        r"\bespert[oi]\b",
    ),
    guards=(r"\bproroga\b", r"\brinnovo\b"),
    vetoes=(
        r"graduatori\w*",
        r"\bnomin[ae]\b",
        r"commission\w* giudicatric\w*",
        r"aggiudicazi\w+",
        r"\bverbale\b",
        r"esit[oi]\b.{0,20}(selezion|valutazion|candidat|graduatori|avviso)",
        r"\bconvocazione\b",
        r"avviso di rettifica",
        r"decret\w+\b.{0,40}(conferiment|attribuzion|approvazion|esclusion|aggiudicaz|graduatori|incaric|cumulativ)",
        r"determin\w+\b.{0,30}(conferiment|attribuzion|aggiudicaz|a contrarre|dirigenzial|impegno|affidamento|liquidazion|indagine|incaric)",
        r"autoattestazione",
        r"autovalutazione",
        r"valutazion\w* (delle )?candidat\w+",
        r"contratt[oi]\b.{0,25}(espert|prestazione d'?opera|collaborazione plurima|stipulat|sottoscritt|occasional)",
        r"\bco\.?co\.?co\b",
        r"anagrafe delle prestazion\w*",
        r"\bscheda\b",
        r"modulistic",
        r"\bmodul[oi]\b.{0,20}(di )?(domanda|richiesta|volontari|autorizzazione|ingresso)",
        r"raccolta dei moduli",
        r"modello (di |per )?(domanda|richiesta|autorizzazione|ingresso)",
        r"dichiarazione sostitutiva",
        r"curriculum vitae",
        r"\bcv\b",
        r"cv[_\s]",
        r"\bcapitolat\w+",
        r"\binventario\b",
        r"\bregolamento\b",
        r"autorizzazione ingresso",
        r"^(albo (online|pretorio)|amministrazione trasparente)\b",
        r"bandi di gara[ \-]",
        r"espert[oi] intern[oi]",
        r"personale (docente )?intern[oi]",
        r"riservat[oa] al personale intern",
    ),
    categories=(
        ("madrelingua", (r"madrelingua", r"lettore di lingua", r"conversazione in lingua")),
        ("psicologo", (r"psicolog", r"sportello (di )?ascolto")),
        ("coding", (r"\bcoding\b", r"programmazion\w+", r"pensiero computazionale")),
        ("robotica", (r"\brobotica\b", r"\brobot\b", r"stem\b")),
        ("digitale", (r"transizione digitale", r"competenz\w+ digital\w+", r"animatore digitale", r"\bdigital\w+\b")),
        ("dm219", (r"dm\s*219", r"d\.m\.?\s*219")),
        ("pon_progettista_collaudatore", (r"progettista", r"collaudatore", r"\bpon\b", r"pnrr")),
        ("formazione", (r"formatore", r"corso di formazione", r"docenza")),
        ("sicurezza", (r"\brspp\b", r"medico competente", r"\bdpo\b", r"\brpd\b", r"d\.?lgs\.?\s*81")),
    ),
    hints={"strong": r"espert|comma", "medium": r"psicolog|ascolto|madrelingua|formator|collaudator|progettist|rspp|medico|dpo|rpd|animator"},
)
