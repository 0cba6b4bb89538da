"""Problem 5: the lines of a mail its sender wrote for it.

Method: threads are reconstructed from reference headers, message lines are
compared with those of their ancestors by rolling-hash shingles and sequence
alignment, and inherited spans are removed.

1. One pass over the texts reads each mail line by line into small flags and one
   hash a line: quote marks and quoting elements, header lines, and what may be
   a closing formula, name, contact line, note or notice.
2. A reference header without marks names the sender of the quoted mail. The
   shingles (rolling hashes of two lines on end) below it are looked up among
   those of that sender's mails; of those known there the rarest and the first
   pick the candidates. Lines below the header and lines of a candidate, quoted
   history of its own included, are aligned; a quote begins where its mail
   begins; the candidate with most aligned lines is the ancestor. Aligned lines,
   and edited ones between them, are inherited.
3. Lines that a tenth of a site's mails hold (the rule of problem 4) are
   notices; others are told by two general marks of such lines (``CUES``).
4. One pass over the flags of each mail decides: marked lines, inherited lines
   and headers are history; signature blocks run from a closing formula, a name
   or a delimiter to the first line that belongs to none.

So below an unmarked header a line is history because it aligns with an
ancestor, and a reply below or inside the quote stays. Only where no mail of the
named sender in the collection says any of what follows (or no address is named)
nothing can be aligned, and the span runs to the next header.

Hot keys: mails of one sender with equal lines are one candidate; a shingle shared
by many of them is taken only where it comes first or no rarer one is known;
notices are counted map-side by line. Mails that merely resemble each other are
no ancestors: without a reference nothing is removed.

Defined results: null, empty and blank texts have no lines; lines are elements
split at ``\\n`` and numbered from 0; rows with a null id are read, but are no
ancestors; reloaded mails are read row by row; a null site has no site lines.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Container, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.boilerplate import needed
from lettermill.llm.names import field
from lettermill.llm.text import share_look_alikes, skeleton, strip_tags
from lettermill.session import Scratch

NEW, BLANK, QUOTED, HEADER, SIGNATURE, NOTICE = range(6)

_LEAD = re.compile(r"^[\s>]*")
_STRUCT = re.compile(r"<(/?)(div|blockquote)\b([^>]*)>", re.I)
_QUOTE_CLASS = re.compile(r"class\s*=\s*[\"'][^\"']*(?:gmail_quote|yahoo_quoted|moz-cite-prefix|protonmail_quote|quoted-text|email-quoted-reply|OutlookMessageHeader|AppleOriginalContents)", re.I)
_SIG_CLASS = re.compile(r"class\s*=\s*[\"'][^\"']*\b\w*(?:sig|signature)\w*\b", re.I)
_ALNUM = re.compile(r"[^\W_]")

_MAIL = r"[^\s<>@]+@[^\s<>@]+"
#: "On <date>, <name> <address> wrote:" in the languages of the mail programs; the address may stand on the next line
_WROTE_END = re.compile(r"(?:\bwrote|\bschrieb\b.*|\ba écrit|\bescribió|\bescreveu)\s*:\s*$", re.I)
_WROTE_ONE = re.compile(
    rf"^<{_MAIL}>:$|^(?:(?:on\b.{{5,}}\bwrote)|(?:am\b.{{5,}}\bschrieb\b.{{2,}})|(?:le\b.{{5,}}\ba écrit)|(?:el\b.{{5,}}\bescribió)|(?:em\b.{{5,}}\bescreveu))\s*:$|^<?{_MAIL}>?\s+(?:wrote|schrieb|a écrit|escribió|escreveu)\s*:$",
    re.I,
)
#: the first half of a header that was broken before the address
_WROTE_HALF = re.compile(r"^(?:on|am|le|el|em)\b.*\b(?:\d{4}|\d{1,2}:\d{2})\b", re.I)
#: a chat-like header: name and time
_SAID = re.compile(r"^[^\W\d_][^\n<>@:]+ \(\d{1,2}[:.]\d{2}\):$")
_FORWARD = re.compile(r"^[-_*=\s]{2,}\s*(?:original|forwarded|ursprüngliche|weitergeleitete|message|mensaje|mensagem|nachricht|begin forwarded)\b[^.]{0,40}[-_*=\s]{2,}$|^begin forwarded message:?$", re.I)
_FIELD = re.compile(r"^\*{0,2}(from|sent|to|cc|bcc|subject|date|von|gesendet|an|betreff|datum|de|envoyé|à|objet|date|enviado|para|asunto|fecha|data|assunto|enviada em)\*{0,2}\s*:\*{0,2}(?:\s|$)", re.I)
_TO = re.compile(r"^\*{0,2}(?:to|cc|bcc|an|à|para)\*{0,2}\s*:", re.I)
_FROM = re.compile(r"^\*{0,2}(?:from|von|de|desde)\*{0,2}\s*:\*{0,2}\s*\S.*@", re.I)

_CLOSE = re.compile(
    r"^(?:(?:with )?(?:best|kind|warm|kindest|warmest)?\s*regards|best(?: wishes)?|cheers|sincerely|yours (?:truly|faithfully|sincerely)|(?:many )?thanks(?: again| a lot| so much| in advance)?|thank you(?: so much| very much| in advance)?"
    r"|(?:talk|speak|chat) soon|all the best|take care|cordially|respectfully|mit freundlichen grüßen|(?:viele|beste|liebe|schöne|herzliche|freundliche) grüße|mit besten grüßen|danke und gruß|gruß|lg|mfg|vg"
    r"|bien à vous|merci d'avance|cordialement|bien cordialement|sincères salutations|bonne journée|à bientôt|un saludo|saludos(?: cordiales)?|atentamente|gracias|muchas gracias|un abrazo"
    r"|abraços|um abraço|obrigad[oa]|muito obrigad[oa]|atenciosamente|cumprimentos|com os melhores cumprimentos|saudações)\s*[,.!]*$",
    re.I,
)
_DASHNAME = re.compile(r"^[-–—]\s?[^\W\d_]+(?:[ \-][^\W\d_]+)?$")
_DEVICE = re.compile(
    r"^(?:sent (?:from|via) .{2,40}|get (?:outlook|gmail) for .{2,20}|envoyé de(?:puis)? mon .{2,30}|von meinem .{2,30} gesendet|gesendet (?:von|mit) .{2,30}|enviado (?:desde|do|de) (?:mi|meu|minha) .{2,30}|diese nachricht wurde von meinem .{2,40})$",
    re.I,
)
_LISTNOTE = re.compile(r"^(?:unsubscribe|view (?:in|it in your) browser|manage (?:your )?preferences|abmelden|im browser ansehen|se désabonner|darse de baja|cancelar inscrição)(?:\s*[|·-]\s*.{0,40})?\.?$", re.I)
#: marks of notices in general, each with parts of words one of which it needs; a line with one of the first, or a sentence with two kinds of the second, is one
_SURE_PARTS = ("disclaimer", "legal", "confiden", "haftungs", "rechtlicher", "avis ", "aviso", "outside", "external", "receiv", "registered", "sitz der", "siège", "domicilio", "unsubscribe", "brought to", "recipient")
_SURE = re.compile(
    r"^(?:disclaimer|legal notice|confidentiality (?:notice|note)|haftungsausschluss|rechtlicher hinweis|avis (?:légal|de confidentialité)|aviso (?:legal|de confidencialidade?))\b"
    r"|originated (?:from )?outside|external (?:sender|e-?mail)\b|\byou (?:are )?receiv(?:e|ed|ing) this\b|\bregistered office\b|\bsitz der gesellschaft\b|\bsiège social\b|\bdomicilio social\b"
    r"|\bunsubscribe\b|\bbrought to you by\b|intended recipient"
)
CUES: tuple[tuple[tuple[str, ...], re.Pattern], ...] = tuple(
    (tuple(parts.split("/")), re.compile(p))
    for parts, p in (
        ("mail/message/communication/transmission/nachricht/courriel/correo/mensa", r"\bthis (?:e-?mail|mail|message|communication|transmission)\b|\bdiese (?:e-?mail|nachricht)\b|\bce (?:message|courriel|mail)\b|\beste (?:mensaje|correo)\b|\besta mensagem\b|\bper e-?mail\b"),
        ("confiden/privileg/vertraulich/proprietary", r"confiden[tc]|privileg|vertraulich|proprietary"),
        ("address/recipient/destin/bestimmt/ for", r"\baddressee|\brecipient|\bdestin(?:é|ad|at)|\bbestimmt\b|\bmeant for\b|\bintended for\b|\bwritten for\b"),
        ("mistake/error/irrtümlich/erreur/engano", r"\bby mistake\b|\bin error\b|irrtümlich|\bpar erreur\b|\bpor error\b|\bpor engano\b"),
        ("delete/remove it/destroy/notify/know/tell /löschen/supprimer/borrar/apagar", r"\bdelete\b|\bremove it\b|\bdestroy\b|\bnotify\b|\blet (?!me\b|us\b)\w+ know\b|\btell \w+|\blöschen\b|\bsupprimer\b|\bborrar\b|\bapagar\b"),
        ("liab/accept/unverbindlich/bind/responsab/haftung", r"\bliab|\baccepts? no\b|\bunverbindlich\b|\bbinds? (?:no|not)\b|\bresponsab|\bhaftung\b"),
        ("unauthor/prohibit/copying/disclosure/disseminat", r"\bunauthori[sz]ed\b|\bprohibited\b|\bcopying\b|\bdisclosure\b|\bdissemination\b"),
        ("print", r"\bbefore (?:you )?print|\bprint(?:ing)? this\b"),
        ("before/environment/umwelt", r"\b(?:consider|think of)\b.*\bbefore\b|\benvironment\b|\bumwelt\b"),
        ("preferences/subscri/newsletter/browser", r"\bpreferences\b|\bsubscri|\bnewsletter\b|\bbrowser\b"),
        ("all /share this/colleague", r"\ball (?:staff|employees|members)\b|\bshare this\b|\bwith a colleague\b"),
        (":", r"^(?:tip|note|notice|reminder|new|hint|announcement|hinweis|neu|nota|rappel|lembrete)\s*:"),
        ("what you/follow", r"\b(?:like|liked|enjoy|enjoyed) what you\b|^follow\b"),
        ("copies", r"\bcopies (?:are|of)\b"),
        ("kept by/retained by", r"\b(?:kept|retained) by\b"),
        ("caution/warning/attention/achtung/not open/unless you", r"^(?:caution|warning|attention|achtung)\b|\bdo not open\b|\bunless you (?:expect|know|recogni)"),
        ("if you are not/unless you are/recipient", r"^(?:if you are not|unless you are)\b|\bnot the\b.{1,30}\brecipient"),
    )
)
_SENTENCE_END = re.compile(r"(?<=[.!])\s+")


def is_notice(s: str) -> bool:
    s = s.casefold()
    if any([p in s for p in _SURE_PARTS]) and _SURE.search(s):
        return True
    may = [rx for parts, rx in CUES if any([p in s for p in parts])]
    return len(may) > 1 and any(sum(bool(rx.search(x)) for rx in may) >= 2 for x in _SENTENCE_END.split(s))


_PHONEISH = re.compile(r"^(?:(?:t|m|f|p|tel|phone|mobile|mob|cell|fax|telefon|tél|office|direct|handy|mobil)\.?\s*[:.]?\s*)?[+(]?\d[\d\s().\-/]{6,}\d$", re.I)
_MAILISH = re.compile(rf"^(?:e-?mail:?\s*)?{_MAIL}(?:\s*[|,·]\s*(?:https?://|www\.)\S+)?$|^(?:https?://|www\.)\S+$", re.I)
_TITLE = re.compile(
    r"^(?:[A-ZÀ-Þ][\w&.'’\-]*|VP|of|and|de|für)(?:\s(?:[A-ZÀ-Þ&][\w&.'’\-]*|of|and|de|für|for)){0,3}\s?(?:\||,| -| –|@| at)\s?[A-ZÀ-Þ][\w&.'’\-]*(?:\s[A-ZÀ-Þ][\w&.'’\-]*){0,4}\.?$", re.UNICODE
)
_COMPANY = re.compile(r"\b(?:inc|ltd|gmbh|llc|corp|plc|ag|s\.?a|sarl|ltda|pty)\.?$", re.I)
_ADDRESS = re.compile(
    r"^\d{1,5} ?[a-z]?(?: bis| ter)?,? .{3,60}$|^(?:[^\W\d_][\w.'’\-]* ){0,3}[^\W\d_][\w.'’\-]* \d{1,4} ?[a-z]?(?:, \d{4,5} .{2,40}|, .{2,40})?$", re.I
)
_IMAGE = re.compile(r"^(?:\[(?:cid|image)\b[^\]]*\]\s*)+$", re.I)
_PS = re.compile(r"^(?:p\.? ?p?\.? ?s\b\.?|nb|n\.b\.)\s*[:.)\-–]?\s", re.I)
_GREETING = re.compile(r"^(?:hi|hello|hey|dear|good (?:morning|afternoon|evening)|hallo|liebe[rs]?|guten (?:tag|morgen)|moin|sehr geehrte\w*|bonjour|salut|cher|chère|hola|buenos días|buenas|estimad\w+|querid\w+|olá|oi|bom dia|boa tarde|prezad\w+|caro|cara)\b", re.I)
_REF = re.compile(r"^(?:id|ref|reference|ticket|case)\b", re.I)
_BULLET = re.compile(r"^(?:[-*•+]{1,2}\s|\d{1,3}[.)]\s|\[[ x]?\]\s)")


def name_entries(given: str | None, family: str | None) -> Iterable[str]:
    """Words of a person's name, in one form and case."""
    return (w for x in (given, family) if x for w in re.findall(r"[^\W\d_]+", Roster.form(x)))


class Roster:
    """Tells lines that hold a name only, by the words of the names of a directory."""

    def __init__(self, words: Container[str]) -> None:
        self.words = words

    @staticmethod
    def form(s: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFD", skeleton(s)) if not unicodedata.combining(c)).casefold()

    def is_name(self, line: str) -> bool:
        if len(line) > 80 or not re.fullmatch(r"[^\W\d_]+(?:[ \-.,]{1,2}[^\W\d_]+){0,3}\.?", line):
            return False
        w = re.findall(r"[^\W\d_]+", self.form(line))
        return 1 <= len(w) <= 4 and all(x in self.words or len(x) == 1 for x in w) and any(len(x) > 1 for x in w)


def _views(lines: list[str]) -> tuple[list[str], list[int], list[int], list[bool]]:
    """For each line: what a reader sees, its depth of quote marks, of quoting elements, and whether it lies in a signature element."""
    seen, marks, boxes, sig = [], [], [], []
    stack: list[tuple[str, int]] = []  # element and what it is: 0 plain, 1 quoting, 2 signature
    depth = [0, 0, 0]  # open elements of each kind
    for line in lines:
        before, in_sig = depth[1], depth[2] > 0
        tagged = "<" in line
        if tagged:
            for m in _STRUCT.finditer(line):
                tag = m.group(2).lower()
                if m.group(1):
                    for i in range(len(stack) - 1, -1, -1):
                        if stack[i][0] == tag:
                            for _, k in stack[i:]:
                                depth[k] -= 1
                            del stack[i:]
                            break
                elif not m.group(3).endswith("/"):
                    kind = 1 if tag == "blockquote" or _QUOTE_CLASS.search(m.group(0)) else 2 if _SIG_CLASS.search(m.group(0)) else 0
                    stack.append((tag, kind))
                    depth[kind] += 1
                    before = max(before, depth[1])
                    in_sig = in_sig or kind == 2
        text = strip_tags(line) if tagged or "&" in line else line
        if not text.isascii():
            text = unicodedata.normalize("NFC", skeleton(text))
        if text[:1] > ">" and text[:1] < "\x7f":  # a letter: no quote marks before it
            marks.append(0)
            seen.append(text.strip())
        else:
            lead = _LEAD.match(text).group(0)
            marks.append(lead.count(">"))
            seen.append(text[len(lead) :].strip())
        boxes.append(before)
        sig.append(in_sig)
    return seen, marks, boxes, sig


def _half(s: str) -> bool:
    return s[-1:] not in ".!?:" and bool(_WROTE_HALF.match(s))


def _header_lines(seen: list[str], marks: list[int]) -> list[bool]:
    n = len(seen)
    head = [False] * n
    filled = [i for i in range(n) if seen[i]]
    pos = {i: k for k, i in enumerate(filled)}
    for i in filled:
        s = seen[i]
        if _WROTE_ONE.match(s):
            head[i] = True
            if s[0] == "<" or "@" in s.split(" ")[0]:
                # the first half stands on the line before
                k = pos[i]
                if k and _half(seen[filled[k - 1]]):
                    head[filled[k - 1]] = True
        elif s[-1] == ":" and _WROTE_END.search(s) and pos[i] and _half(seen[filled[pos[i] - 1]]) and "@" in s:
            head[i] = head[filled[pos[i] - 1]] = True
        elif _FORWARD.match(s):
            head[i] = True
        elif s.endswith("):") and _SAID.match(s):
            k = pos[i]
            head[i] = k + 1 < len(filled) and marks[filled[k + 1]] > marks[i]
    # blocks of fields: two or more, one of them the sender's
    i = 0
    while i < len(filled):
        j = i
        while j < len(filled) and (_FIELD.match(seen[filled[j]]) or (j > i and head[filled[j]])):
            j += 1
        block = [k for k in filled[i:j] if _FIELD.match(seen[k])]
        if len(block) >= 2 and (any(_FROM.match(seen[k]) for k in block) or len(block) >= 3 or (i and head[filled[i - 1]])):
            for k in block:
                head[k] = True
        i = max(j, i + 1)
    return head


_ADDR = re.compile(r"[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}", re.I)


# ---------------------------------------------------------------- flags of lines

BLANK_, HEAD, MARKED, SIGBOX, CLOSE, DASH, NAME, COMMA, SIGLIKE, PS, OWN, NOTE, CUE, DELIM, LONG, OPENS, HELLO = (1 << k for k in range(17))
SHINGLE_BASE = 0x5851F42D4C957F2D
_M64, _START = (1 << 64) - 1, 0x9E3779B97F4A7C15


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def roll(a: int, b: int) -> int:
    """Rolling hash of two lines on end."""
    return _signed((a * SHINGLE_BASE + b) & _M64)


class Lines:
    """Reads a text into flags, hashes and reference headers; a line's own flags are kept (bounded)."""

    def __init__(self, roster: Roster) -> None:
        import xxhash

        self.roster, self.h64 = roster, xxhash.xxh3_64_intdigest
        self.kept: dict[str, tuple[int, int]] = {}

    def line(self, s: str) -> tuple[int, int]:
        """Flags that a visible line has by itself, and the hash of its words (0 without any)."""
        got = self.kept.get(s)  # quoted lines are mostly met again
        if got is not None:
            return got
        words = " ".join(re.findall(r"\w+", s.casefold()))
        if not words or _IMAGE.match(s) or not _ALNUM.search(s):
            f = BLANK_ | (DELIM if s in ("--", "—", "____________________") else 0)
            got = (f, 0)
        else:
            r, f = self.roster, 0
            close = _CLOSE.match(s)
            name = r.is_name(s)
            note = _DEVICE.match(s) or _LISTNOTE.match(s)
            if close:
                f |= CLOSE
            if name:
                f |= NAME
            if _DASHNAME.match(s) and r.is_name(s.lstrip("-–— ")):
                f |= DASH
            if s.endswith(","):
                f |= COMMA
            if note:
                f |= NOTE | SIGLIKE
            elif name or _PHONEISH.match(s) or _MAILISH.match(s) or (len(s) <= 70 and (_TITLE.match(s) or _COMPANY.search(s))) or (len(s) <= 90 and s[-1:] not in ".!?" and _ADDRESS.match(s)):
                f |= SIGLIKE
            if _PS.match(s):
                f |= PS
            if _REF.match(s) or _BULLET.match(s):
                f |= OWN
            if not (close or name) and is_notice(s):
                f |= CUE
            if sum(map(str.isalnum, s)) >= 20:
                f |= LONG
            elif _GREETING.match(s):
                f |= HELLO
            got = (f, self.h64(words.encode("utf-8", "surrogatepass")) or 1)
        if len(self.kept) >= 200_000:
            self.kept.clear()
        self.kept[s] = got
        return got

    def read(self, text: str) -> tuple[list[int], list[int], list[tuple[int, str]]]:
        """Flags and hashes of the lines, and ``(last line, address)`` of each reference header without marks."""
        lines = text.split("\n")
        n = len(lines)
        seen, marks, boxes, sig_box = _views(lines)
        head = _header_lines(seen, marks)
        flags, hashes = [0] * n, [0] * n
        refs: list[tuple[int, str]] = []
        last = -2
        for i in range(n):
            s = seen[i]
            f, h = self.line(s) if s else (BLANK_, 0)
            if marks[i] or boxes[i]:
                f |= MARKED
            if sig_box[i]:
                f |= SIGBOX
            if head[i]:
                f |= HEAD
                if not f & MARKED:
                    nxt = next((j for j in range(i + 1, n) if seen[j] and not head[j] and (_ALNUM.search(seen[j]) or marks[j])), None)
                    if nxt is not None and not marks[nxt] and not boxes[nxt]:
                        named = _ADDR.search(s)
                        address = named.group(0).lower() if named and not _TO.match(s) else ""
                        # the lines of one header block are one reference
                        if refs and last == i - 1:
                            flags[refs[-1][0]] &= ~OPENS
                            refs[-1] = (i, refs[-1][1] or address)
                        else:
                            refs.append((i, address))
                        f |= OPENS
                        last = i
            flags[i], hashes[i] = f, h
        return flags, hashes, refs


# ---------------------------------------------------------------- alignment


def longest_run(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs in which both places increase."""
    tails: list[int] = []
    at: list[int] = []
    nodes: list[tuple[int, int, int]] = []
    for k, p in sorted(pairs, key=lambda x: (x[0], -x[1])):
        j = bisect_left(tails, p)
        nodes.append((k, p, at[j - 1] if j else -1))
        tails[j : j + 1] = [p]
        at[j : j + 1] = [len(nodes) - 1]
    run: list[tuple[int, int]] = []
    i = at[-1] if at else -1
    while i >= 0:
        k, p, i = nodes[i]
        run.append((k, p))
    return run[::-1]


def align(mine: Sequence[tuple[int, int]], theirs: Sequence[int]) -> tuple[int, int, list[int]]:
    """Number of aligned lines, first position met, and the inherited lines: aligned ones and edited ones between them.

    ``mine`` holds ``(line_no, hash)``, ``theirs`` hashes. An alignment is the longest run in which both
    increase; what it leaves is aligned again while a run of two lines or more is found, for mail
    programs put the reply before or after what it quotes. A line that either side repeats meets in
    order of occurrence, from the front and from the back, so repeats make no product.
    """
    places: dict[int, list[int]] = defaultdict(list)
    for p, h in enumerate(theirs):
        places[h].append(p)
    mine_at: dict[int, list[int]] = defaultdict(list)
    for k, (_, h) in enumerate(mine):
        if h in places:
            mine_at[h].append(k)
    pairs: set[tuple[int, int]] = set()
    for h, ks in mine_at.items():
        ps = places[h]
        pairs.update(zip(ks, ps))
        pairs.update(zip(reversed(ks), reversed(ps)))
    met: dict[int, int] = {}
    while len(run := longest_run(pairs)) >= (2 if met else 1):
        met.update(run)
        done = set(met.values())
        pairs = {(k, p) for k, p in pairs if k not in met and p not in done}
    told: list[int] = []
    order = sorted(met)
    for k, k2 in zip(order, [*order[1:], len(mine)]):
        told.append(mine[k][0])
        # lines on both sides that do not match are an edit, lines on this side only are new; so is what follows the end
        if k2 < len(mine) and met[k2] - met[k] > 1:
            told += [mine[x][0] for x in range(k + 1, k2)]
    return len(met), min(met.values(), default=-1), told


def decide(flags: Sequence[int], inherited: Container[int], open_heads: Container[int], site_lines: Container[int]) -> list[int]:
    """The class of each line of a mail."""
    n = len(flags)
    out = [NEW] * n
    below = to_end = False
    for i, f in enumerate(flags):
        if f & HEAD:
            out[i] = HEADER
            if f & OPENS:
                below, to_end = True, i in open_heads
        elif f & BLANK_:
            out[i] = BLANK
        elif f & MARKED or (below and (to_end or i in inherited)):
            out[i] = QUOTED
        elif f & SIGBOX:
            out[i] = SIGNATURE
        elif i in site_lines or f & (CUE | NOTE):
            out[i] = NOTICE
    # blocks: from an opener on, until text that belongs to no signature
    tail = [True] * (n + 1)  # whether only signature lines, notices, quotes or a postscript follow
    for i in range(n - 1, -1, -1):
        f = flags[i]
        tail[i] = True if out[i] in (QUOTED, HEADER) else tail[i + 1] if out[i] != NEW else bool(f & PS) or (bool(f & (SIGLIKE | CLOSE)) and tail[i + 1])
    i = 0
    while i < n:
        f = flags[i]
        opener = bool(f & (CLOSE | DASH)) or (bool(f & NAME) and i > 0 and not f & COMMA and tail[i + 1]) if out[i] == NEW else out[i] == BLANK and bool(f & DELIM) and tail[i + 1]
        if not opener:
            i += 1
            continue
        if out[i] == NEW:
            out[i] = SIGNATURE
        i += 1
        while i < n and out[i] not in (QUOTED, HEADER):
            if out[i] == NEW:
                if flags[i] & (PS | OWN) or not flags[i] & (CLOSE | SIGLIKE):
                    break
                out[i] = SIGNATURE
            i += 1
    return out


# ---------------------------------------------------------------- operator

_SHAPE = "id long, doc long, src long, flags array<int>, h array<long>, said array<long>, sh array<long>, refs array<struct<line:int,address:string,sh:array<long>>>"


def _read(words: Container[str]):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = Lines(Roster(words))
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for t in b.column(3).to_pylist():
                flags, hashes, refs = lines.read(t)
                at = [i for i, h in enumerate(hashes) if h and not flags[i] & HEAD]
                said = [hashes[i] for i in at]
                # pairs that end in a line of content: closings, names, contacts and greetings say little
                full = [not flags[i] & (CLOSE | DASH | NAME | SIGLIKE | NOTE | CUE | HELLO) for i in at]
                pairs = [roll(a, c) if f else 0 for a, c, f in zip([_START, *said], said, full)]
                spans = []
                for k, (line, address) in enumerate(refs):
                    lo = bisect_left(at, line)
                    hi = bisect_left(at, refs[k + 1][0]) if k + 1 < len(refs) else len(at)
                    first = [roll(_START, said[lo])] if hi > lo and full[lo] else []
                    spans.append({"line": line, "address": address, "sh": first + [p for p in pairs[lo + 1 : hi] if p]})
                for c, x in zip(cols, (flags, [_signed(h) for h in hashes], [_signed(h) for h in said], [p for p in pairs if p], spans), strict=True):
                    c.append(x)
            longs = pa.list_(pa.int64())
            arrays = [pa.array(cols[0], pa.list_(pa.int32())), pa.array(cols[1], longs), pa.array(cols[2], longs), pa.array(cols[3], longs)]
            refs_ = pa.array(cols[4], pa.list_(pa.struct([("line", pa.int32()), ("address", pa.string()), ("sh", longs)])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *arrays, refs_], names=["id", "doc", "src", "flags", "h", "said", "sh", "refs"])

    return run


#: an ancestor's text is met within its first lines: a banner or greeting may be left out
BEGIN = 3


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, begin, told = [], [], []
        for line, flags, h, said in zip(*(b.column(k).to_pylist() for k in (1, 3, 4, 5)), strict=True):
            mine = [(i, h[i]) for i in range(line + 1, len(h)) if h[i] and not flags[i] & HEAD]
            got = align(mine, said)
            n.append(got[0] if 0 <= got[1] <= BEGIN else 0)
            begin.append(got[1])
            told.append(got[2])
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n, pa.int32()), pa.array(begin, pa.int32()), pa.array(told, pa.list_(pa.int32()))], names=["id", "line", "anc", "n", "begin", "told"])


_INHERITED, _OPEN, _SITE = 0, 1, 2


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, no = [], []
        for i, flags, marks in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            sets: list[set[int]] = [set(), set(), set()]
            for m in marks or ():
                sets[m & 3].add(m >> 2)
            new = [k for k, c in enumerate(decide(flags, *sets)) if c == NEW]
            ids += [i] * len(new)
            no += new
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(no, pa.int32())], names=["id", "line_no"])


def new_lines(texts: Sequence[tuple[DataFrame, str, str]], senders: DataFrame, directory: DataFrame, doc: str = "eid", source: str = "site", least_docs: int = 10, share: float = 0.1) -> list[DataFrame]:
    """For each ``(table, key, text)`` the frame ``(key, line_no)`` of its new lines.

    ``senders (eid, from_addr)`` tells who wrote a mail; ``directory`` holds the names that sign mails.
    Mails of all tables are ancestors to each other; a table without the column ``source`` has no site
    lines of its own, but those of the others count in it.
    """
    spark = texts[0][0].sparkSession
    share_look_alikes(spark)
    scratch = Scratch(spark, "new-lines")
    words = field(directory, name_entries)
    rows, need = None, None
    for k, (df, key, text) in enumerate(texts):
        src = F.when(F.col(source).isNotNull(), F.xxhash64(F.col(source).cast("string"))) if source in df.columns else F.lit(None).cast("long")
        part = df.where(F.col(text).isNotNull() & (F.length(text) > 0)).select((F.col(key).cast("long") * len(texts) + k).alias("id"), F.when(F.col(doc).isNotNull(), F.xxhash64(doc)).alias("doc"), src.alias("src"), F.col(text).alias("t"))
        rows = part if rows is None else rows.union(part)
        if source in df.columns:
            limit = needed(df, source, doc, least_docs, share)
            need = limit if need is None else need.union(limit)
    mails = scratch.cut(rows.mapInArrow(_read(words), _SHAPE))

    # who wrote what: only senders that some reference names
    refs = mails.where("size(refs) > 0").select("id", F.xxhash64("said").alias("ah"), F.explode("refs").alias("r")).select("id", "ah", "r.*")
    refs = scratch.cut(refs)
    asked = refs.where("address <> ''").select("address").distinct()
    who = senders.where("eid is not null and from_addr is not null").select(F.xxhash64("eid").alias("doc"), F.lower("from_addr").alias("address")).distinct().join(asked, "address", "left_semi")
    # mails of one sender with equal lines are one
    elders = mails.where("doc is not null and size(said) > 0").select("doc", "said", "sh").join(who, "doc").withColumn("ah", F.xxhash64("said"))
    elders = scratch.cut(elders.select("address", "ah", "said", "sh").dropDuplicates(["address", "ah"]).withColumn("anc", F.xxhash64("address", "ah")))

    # of the shingles below a header that the sender's mails know, the rarest and the first
    posted = elders.select("address", "anc", F.explode(F.array_distinct("sh")).alias("sh"))
    wanted = refs.where("address <> ''").select("id", "line", "ah", "address", F.posexplode(F.array_distinct("sh")).alias("pos", "sh"))
    keys = wanted.select("address", "sh").distinct()
    posted = scratch.cut(posted.join(keys, ["address", "sh"], "left_semi"))
    often = posted.groupBy("address", "sh").agg(F.count(F.lit(1)).alias("n"))
    best = scratch.cut(wanted.join(often, ["address", "sh"]).groupBy("id", "line", "ah", "address").agg(F.min(F.struct("n", "sh")).alias("b"), F.min(F.struct("pos", "sh")).alias("f")))
    met = best.select("id", "line", "ah", "address", F.explode(F.array_distinct(F.array("b.sh", "f.sh"))).alias("sh")).join(posted, ["address", "sh"])
    met = met.where(F.col("anc") != F.xxhash64("address", "ah")).select("id", "line", "anc").distinct()
    both = met.join(elders.select("anc", "said"), "anc").join(mails.select("id", "flags", "h"), "id").select("id", "line", "anc", "flags", "h", "said")
    runs = both.mapInArrow(_aligned, "id long, line int, anc long, n int, begin int, told array<int>").where("n > 0")
    told = runs.groupBy("id", "line").agg(F.max(F.struct("n", (-F.col("begin")).alias("b"), "anc", "told")).alias("r"))
    told = told.select("id", F.explode("r.told").alias("k"), F.lit(_INHERITED).alias("what"))
    # no mail of that sender says any of it: nothing to align with
    opened = refs.join(best.select("id", "line"), ["id", "line"], "left_anti").select("id", F.col("line").alias("k"), F.lit(_OPEN).alias("what"))
    marks = told.union(opened)

    # lines that many mails of one site hold
    if need is not None:
        z = F.arrays_zip("flags", "h")
        lines = mails.select("id", "src", "doc", F.posexplode(z).alias("k", "z")).where(F.col("z.flags").bitwiseAND(LONG) != 0)
        lines = lines.select("id", "src", "doc", "k", F.col("z.h").alias("h"), (F.col("z.flags").bitwiseAND(MARKED | HEAD) == 0).alias("open"))
        need = scratch.cut(need.groupBy("src").agg(F.max("need").alias("need")))
        sited = lines.where("src is not null and doc is not null")
        # occurrences bound the documents from above
        often = scratch.cut(sited.groupBy("src", "h").agg(F.count(F.lit(1)).alias("n")).join(need, "src").where("n >= need").select("src", "h"))
        heavy = sited.join(often, ["src", "h"], "left_semi").select("src", "h", "doc").distinct().groupBy("src", "h").agg(F.count(F.lit(1)).alias("n"))
        heavy = scratch.cut(heavy.join(need, "src").where("n >= need").select("h").distinct())
        marks = marks.union(lines.where("open").join(heavy, "h", "left_semi").select("id", "k", F.lit(_SITE).alias("what")))

    of = marks.groupBy("id").agg(F.collect_set((F.col("k") * 4 + F.col("what")).cast("int")).alias("marks"))
    found = scratch.cut(mails.select("id", "flags").join(of, "id", "left").mapInArrow(_decided, "id long, line_no int"))
    scratch.keep_only(found)
    part = lambda k: F.pmod("id", F.lit(len(texts))) == k
    return [found.where(part(k)).select(((F.col("id") - k) / len(texts)).cast("long").alias(key), "line_no") for k, (_, key, _) in enumerate(texts)]
