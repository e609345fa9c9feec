"""Template residue, filler, error pages and script notices in place of content.

Numbers, addresses, dates and request marks of every text are masked and all masked messages, of any length, are
grouped by their exact hash over all sources, so that a message is judged once however often it recurs. The phrase
rules take a message apart into sentences. How much a rule asks for depends on how widely the message recurs:
a message seen in few sources is residue if each sentence is a known kind of notice or its usual company (navigation,
reference marks, advice to retry) and at least one is such a notice, one sentence in ten being free; one that recurs
widely may have one foreign sentence, or be made of sentences that merely sound like notices (they speak of failures,
refusals, browsers or waiting, or address the visitor) for more than half. Slots of templates are
found by their spelling in texts of any length; a slot that is spoken of (in an explanation) or used (in a script) is none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.shared import cut

#: Share of the sentences of a message that may be foreign to notices.
FOREIGN = 0.1
#: A sentence that is a notice is not longer, filler apart; one that speaks of a notice mostly is.
NOTICE_CHARS = 90
#: Share of the sentences of a widely recurring message that have to sound like notices (more than).
HINTED = 0.5
#: Hashes of widely recurring messages that are broadcast at most, 24 bytes each; more are joined by a shuffle.
ASKED = 100_000
#: A message is widely recurring from so many sources on.
SOURCES = 3

# Phrases of notices, as regular expressions over lower-case masked sentences.
_NOTICES = [
    # scripts and cookies
    r"(javascript|java script|cookies?) (is|are|has been|must be|needs? to be) (disabled|turned off|required|enabled|blocked)",
    r"(enable|activate|allow|turn on|accept) (javascript|java script|scripts?|cookies?)", r"turn on (cookies|scripts|them)", r"turn them on",
    r"(viewer|page|site|app|application|portal|website) (needs|requires) (scripts?|javascript|cookies)", r"(needs|requires) (scripts|javascript|cookies)",
    r"(включите|разрешите|активируйте) (javascript|java script|скрипты|сценарии|cookies?|куки)",
    r"(требуется|необходима|нужна|требуются) (поддержка|включ\w+)? ?(javascript|скриптов|сценариев|cookies?|скрипты|куки)",
    r"браузер не (выполняет|поддерживает) (сценарии|скрипты|javascript|cookies?)", r"(javascript|скрипты|сценарии|cookies?|куки) (отключ|выключ|заблокир)\w+",
    # error pages
    r"^(http )?(error )?#+ ?[-—:.]* ?(not found|forbidden|bad gateway|service unavailable|internal server error|gateway time-?out|unauthorized|bad request|method not allowed|too many requests|gone)",
    r"^(not found|forbidden|bad gateway|service (temporarily )?unavailable|internal server error|gateway time-?out|access denied|too many requests|page not found)",
    r"^(страница|файл|документ|ресурс) не найден[аоы]?$", r"^доступ (запрещ[её]н|закрыт|ограничен)", r"сервис (временно )?недоступен", r"внутренняя ошибка сервера",
    r"сеанс (ист[её]к|заверш[её]н)", r"запрошенн\w+ (файл|страница|документ|ресурс)\w* (удал|не найд|перемещ)\w+", r"слишком много запросов", r"запрос (отклон|заблокир)\w+",
    r"проверка (вашего )?браузера", r"^checking your browser", r"traceback: ", r"template error", r"undefined variable", r"не удалось сформировать страницу", r"rendering stopped",
    r"you do not have permission", r"(upstream|server) did not (reply|respond)", r"requested (document|page|url|file|resource) (does not exist|was not found|could not be found)", r"^session (has )?expired",
    # filler
    r"lorem ipsum", r"текст-заполнитель", r"^образец текста$", r"^здесь будет (текст|содержание|описание)", r"^(раздел|страница|документ|сайт) (находится )?в разработке$", r"описание уточняется", r"заполнить позднее",
    r"^текст появится позже$", r"^todo\b", r"^tbd\b", r"^(sample|placeholder|dummy|filler) text", r"^under construction", r"^coming soon", r"^(рыба|рыбный текст)",
]
_COMPANY = [
    r"^[#@№:\s.,!—|/-]*$", r"^(ref|ray|request|код|id|№)( id| обращения)?:? *[#@\w-]*$", r"request id [#@]+$", r"^(home|search|contacts|главная|поиск|контакты|назад|back|help|помощь|войти|login)( *[|/·•-] *\w+)*$",
    r"вернитесь на главную", r"обратитесь к администратору", r"проверьте адрес", r"повторите попытку", r"обновите страницу", r"reload", r"try again", r"код обращения", r"^ошибка #+", r"узел #+", r"подождите", r"войдите снова",
    r"some parts cannot be shown", r"страница не может быть показана", r"before opening", r"go back", r"contact (the|your) administrator",
    r"^traceback \(most recent call last\)", r"^file \"[^\"]*\", line #(, in \S+)?$", r"^(file|at) \S+\(\S*\)$",
]
# Beginnings of sentences that are filler however long they are, and words that invented Latin is made of.
_FILLER = [
    r"^lorem ipsum dolor", r"^ut enim ad minim veniam", r"^duis aute irure dolor", r"^excepteur sint occaecat", r"^sed ut perspiciatis unde omnis", r"^nemo enim ipsam voluptatem", r"^neque porro quisquam est",
]
FILLER = "|".join(_FILLER)
#: A sentence of invented Latin: Latin letters only, none of the words that English needs and Latin lacks, and a word of the filler.
LATIN = r"^(?!.*\b(?:the|of|is|are|an|and|for|to|on|with|by|from|or|that|this)\b)(?=.*\b(?:ipsum|dolor|amet|consectetur|adipiscing|elit|vestibulum|pellentesque|nulla|quis|nec|eget|sed|vel|et|ut)\b)[a-z\s,;:'-]+$"
# What notices speak of, as beginnings of words; evidence only for a message that recurs widely.
_HINTS = (
    "error", "fail", "unavailab", "denied", "forbidden", "refused", "disabled", "expired", "timed out", "timeout", "maintenance", "blocked", "not found", "not supported", "javascript", "cookie", "browser", "captcha", "redirect",
    "sorry", "oops", "please", "try again", "retry", "reload", "refresh", "contact support", "ошибк", "сбой", "сбо", "неполадк", "недоступ", "запрещ", "отказано", "отклон", "истек", "истёк", "не отвеча", "не найден", "не поддержива",
    "технически", "профилактическ", "заблокирован", "отключ", "браузер", "капч", "перенаправл", "извин", "пожалуйста", "попробуйте", "повторите", "обновите", "обратитесь", "подождите", "включите", "вернитесь", "скоро верн",
)
HINT = r"(?<![\p{L}\p{N}])(?:" + "|".join(_HINTS) + ")"
NOTICE, COMPANY = "|".join(f"(?:{p})" for p in _NOTICES), "|".join(f"(?:{p})" for p in _COMPANY)
#: Whether any notice may stand somewhere in a message; looked for at the beginnings of words only.
_ANY_NOTICE = r"(?<![\p{L}\p{N}])(?:" + "|".join(f"(?:{p.removeprefix('^').removesuffix('$')})" for p in _NOTICES + _FILLER) + ")"

# Spellings of template slots.
_NAME = r"[\p{L}_][\p{L}\p{N}_.]*"
_SLOTS = [
    rf"\{{\{{ *{_NAME} *\}}\}}", rf"\$\{{{_NAME}\}}", rf"@@{_NAME}@@", rf"(?<![\p{{L}}\p{{N}}%])%[\p{{L}}_]{{3,}}%(?![\p{{L}}\p{{N}}%])", rf"(?<![\p{{L}}\p{{N}}{{$#\"':\[])\{{{_NAME}\}}(?!\}})",
    rf"<%=? *{_NAME} *%>", rf"\{{% *{_NAME}[^%]*%\}}", rf"#\{{{_NAME}\}}", rf"\[\[ *{_NAME} *\]\]",
    r"<<? ?(?:[А-ЯЁ]{2,}(?: [А-ЯЁ]+)*|[A-Z]{3,}(?:[ _][A-Z]+)+|(?i:ваш|ваша|укажите|вставьте|вставить|введите|your|insert)(?: [\p{L}]+)+) ?>>?",
    r"#(?:[А-ЯЁ]{2,}(?: [А-ЯЁ]+)*|[A-Z]{3,}(?:[ _][A-Z]+)+|(?i:ваш|ваша|укажите|вставьте|вставить|введите|your|insert)(?: [\p{L}]+)+)#",
    r"\[ ?(?:[А-ЯЁ]{2,}(?: [А-ЯЁ]+)+|[A-Z]{3,}(?:[ _][A-Z]+)+|(?i:ваш|ваша|укажите|вставьте|вставить|введите|your|insert)(?: [\p{L}]+)+) ?\]",
]
SLOT = "|".join(f"(?:{p})" for p in _SLOTS)
#: Sentences that explain slots, and script lines that use them.
SPOKEN = r"(?im)(?:^|(?<=[.!?…]\s))[^\n.!?]*\b(?:например|вида|обозначают|обозначает|подстановк\w+|синтаксис\w*|for example|such as|e\.g\.|denotes?|stands? for|placeholders?|syntax)\b[^\n!?]*?(?=[.!?](?:\s|$)|\n|$)"
SCRIPT = r"(?m)(?:^|(?<=\s))(?:export \w+=|for \w+ in |echo |set |if \[ |while |curl |\$ )[^\n]*"
# Words that running English or Russian text does not do without.
_FUNCTION_WORDS = r"(?i)\b(the|of|is|are|an|and|for|to|in|on|with|by|from|at|or|that|this|и|в|на|с|для|не|по|к|при|из)\b"


def masked(text: Column) -> Column:
    """A text with numbers, dates, addresses and request marks masked, in lower case with single spaces."""
    steps = [
        (r"(?i)\b(?:https?://|www\.)\S+|\b[\w.+-]+@[\w-]+\.\w+", "@"),
        (r"(?i)\b(?=[0-9a-f-]*[0-9])(?=[0-9a-f-]*[a-f])[0-9a-f-]{4,}\b", "#"),
        (r"\d+(?:[.:,/-]\d+)*", "#"),
        (r"'[^'\n]{1,40}'", "'@'"),
        (r"[\s\x{A0}\x{3000}]*[\r\n]+[\s\x{A0}\x{3000}]*", "\u0001"),
        (r"[\s\x{A0}\x{3000}]+", " "),
    ]
    return F.lower(F.trim(reduce(lambda c, s: F.regexp_replace(c, *s), steps, text)))


def _sentences(message: Column) -> Column:
    parts = F.regexp_replace(message, r"((?:[.!?…](?=\s|$|№|ref|ray|главная|home))|\s(?:[|/—])\s|(?<=\p{L})(?=№ ?#)|,? (?=главная / |home \| ))\s*", "\u0001")
    return F.filter(F.transform(F.split(parts, "\u0001"), lambda s: F.regexp_replace(s, r"^[\s.!?…,;:—|/]+|[\s.!?…,;:—|/]+$", "")), lambda s: s != "")


def notice(message: Column, widely: Column) -> Column:
    """Whether a masked message is a notice: nothing but notices and their company, and some notice."""
    parts = _sentences(message)
    says = lambda s: (s.rlike(NOTICE) & (F.length(s) <= NOTICE_CHARS)) | s.rlike(FILLER)
    hits = F.size(F.filter(parts, says))
    latin = F.exists(parts, lambda s: s.rlike(FILLER))
    foreign = F.size(F.filter(parts, lambda s: ~says(s) & ~s.rlike(COMPANY) & ~(latin & s.rlike(LATIN))))
    return (hits > 0) & ((foreign <= F.size(parts) * FOREIGN) | (widely & (foreign == 1) & (hits >= foreign)))


def sounds_like_notice(message: Column) -> Column:
    """Whether most sentences of a masked message merely sound like a notice; for messages that recur widely only."""
    parts = _sentences(message)
    return F.exists(parts, lambda s: s.rlike(HINT)) & (F.size(F.filter(parts, lambda s: s.rlike(HINT) | s.rlike(COMPANY))) > F.size(parts) * HINTED)


def slots_left(text: Column) -> Column:
    """Whether a text has unfilled slots that are neither explained nor part of a script."""
    bare = F.regexp_replace(F.regexp_replace(text, SCRIPT, " "), SPOKEN, " ")
    return text.rlike(r"[\[{<%@#]") & bare.rlike(SLOT)


def pseudo_words(text: Column) -> Column:
    """Whether a text is filler of invented words: Latin words only, none of the words a language needs, few of them ever new."""
    words = F.split(F.lower(F.regexp_replace(text, r"[^A-Za-z]+", " ")), " ")
    shape = text.rlike(r"^[A-Za-z\s.,;!?-]{60,}$") & ~text.rlike(_FUNCTION_WORDS)
    return shape & (F.size(words) >= 12) & (F.size(F.array_distinct(words)) < F.size(words) * 0.7)


def residue(docs: DataFrame) -> DataFrame:
    """``(doc_id, reason)`` of the documents that hold no content, each id once.

    ``reason`` is ``slots``, ``filler`` or ``notice``. Null, empty and blank texts are no case. A null source
    counts as a source of its own; repeated rows are judged alike; a null id is left out.
    """
    docs = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"))
    docs = docs.where("doc_id is not null").where(F.col("text").rlike(r"[^\s\x{A0}\x{3000}]"))
    messages = docs.select("doc_id", "source", masked(F.col("text")).alias("message"))
    # all messages are grouped by their hash; the text itself goes along only where a phrase of a notice stands in it
    hashes = F.xxhash64("message").alias("h1"), F.hash("message").alias("h2")
    messages = cut(messages.select("doc_id", "source", *hashes, F.when(F.col("message").rlike(_ANY_NOTICE), F.col("message")).alias("message")), "messages")
    # by source first, so that a message that holds a third of all rows is counted in parts
    by_source = messages.groupBy("h1", "h2", "source").agg(F.max("message").alias("message"), F.min("doc_id").alias("doc_id"))
    grouped = cut(by_source.groupBy("h1", "h2").agg(F.max("message").alias("message"), F.min("doc_id").alias("doc_id"), F.count("*").alias("sources")).where("message is not null or sources >= " + str(SOURCES)), "grouped")
    judged = grouped.where("message is not null").where(notice(F.col("message"), F.col("sources") >= SOURCES)).select("h1", "h2")
    # messages that recur widely are few; each is read again in one of its documents
    asked = grouped.where(F.col("sources") >= SOURCES).select("doc_id", F.col("h1").alias("w1"), F.col("h2").alias("w2"))
    asked = F.broadcast(asked) if asked.limit(ASKED + 1).count() <= ASKED else asked
    # written before it is masked and judged, or that would be pushed down to all documents
    wide = cut(docs.join(asked, "doc_id").select("w1", "w2", "text"), "wide").select("w1", "w2", masked(F.col("text")).alias("message"))
    wide = wide.where((F.xxhash64("message") == F.col("w1")) & (F.hash("message") == F.col("w2")))
    judged = judged.unionByName(wide.where(sounds_like_notice(F.col("message"))).select(F.col("w1").alias("h1"), F.col("w2").alias("h2"))).distinct()
    notices = messages.join(judged, ["h1", "h2"], "left_semi").select("doc_id", F.lit("notice").alias("reason"))
    marked = docs.select("doc_id", F.when(slots_left(F.col("text")), "slots").when(pseudo_words(F.col("text")), "filler").alias("reason")).where("reason is not null")
    return marked.unionByName(notices).groupBy("doc_id").agg(F.max("reason").alias("reason"))


def content(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without residue, all columns kept; null, empty and blank texts stay."""
    found = residue(docs).select(F.col("doc_id").alias("_residue_id"))
    return docs.join(found, docs["doc_id"] == found["_residue_id"], "left_anti")
