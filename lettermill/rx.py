"""Patterns both Java and RE2 read alike.

Blanks are written out (neither engine's ``\\s`` is Unicode by default), word
boundaries consume a character instead of looking around, and ``.`` is given as
"all but newline".
"""

from __future__ import annotations

#: Unicode blanks, for use inside a class
WS = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S, NS = f"[{WS}]", f"[^{WS}]"
#: any character but a newline; word characters
A, W = r"[^\n]", r"[\p{L}\p{N}_]"
LB, RB = r"(?:^|[^\p{L}\p{N}_])", r"(?:$|[^\p{L}\p{N}_])"


def anchored(*alternatives: str) -> str:
    return "^(?:" + "|".join(alternatives) + ")"


def ci(pattern: str) -> str:
    """Case does not count; in Java."""
    return "(?iud)" + pattern


def ci2(pattern: str) -> str:
    """Case does not count; in RE2."""
    return "(?i)" + pattern


# fixed values: where a reply chain begins (start of a stripped line)
REPLY_TRIGGERS = anchored(
    rf"on{S}+{A}{{5,120}}{S}+wrote{S}*:{S}*$",
    rf"-{{3,}}{S}*(?:original|forwarded){S}+message{S}*-{{3,}}",
    rf"from{S}*:{S}+{NS}+{A}*sent{S}*:{S}+",
    rf"\*{{1,2}}from\*{{0,2}}{S}*:\*{{0,2}}{S}+{NS}+",
    rf"(?:de|von|da){S}*:{S}+{NS}+",
    r">",
    rf"\\--{S}*$",
    rf"--{S}*$",
    rf"begin{S}+forwarded{S}+message",
    rf"{A}{{0,40}}inviting you to a scheduled",
    rf"join{S}+(?:zoom|microsoft{S}+teams|webex|google{S}+meet){S}+(?:meeting|call)",
    rf"invitation{S}+from{S}+\[?google{S}+calendar",
    r"you[\x{2019}']?re invited to".replace(" ", f"{S}+"),
)
# fixed values: what opens a disclaimer (a word boundary before)
DISCLAIMER_TRIGGERS = LB + "(?:" + "|".join(
    (
        rf"disclaimer{S}*:",
        rf"confidentiality{S}*(?:notice|statement)?{S}*:",
        rf"legal{S}*(?:notice|disclaimer){S}*:",
        rf"(?:alert|caution|warning|important{S}*(?:notice|disclaimer)?|privileged?{S}*(?:notice)?){S}*:",
        rf"private{S}*&?{S}*confidential{RB}",
        rf"(?:originated{S}+outside|external{S}+(?:sender|email)){RB}",
        rf"(?:clicking{S}+any{S}+link|opening{S}+an{S}+attachment){RB}",
        rf"this{S}+(?:e-?mail|message|communication){S}+(?:is|may{S}+be){S}+(?:confidential|privileged)",
        rf"if{S}+you{S}+(?:are{S}+not{S}+the{S}+intended|have{S}+received{S}+this|received{S}+this{S}+in{S}+error)",
        rf"any{S}+(?:use|disclosure|distribution|copying){S}+(?:of{S}+this|is){S}+(?:prohibited|unauthorized|unlawful)",
        rf"please{S}+(?:delete|destroy){S}+(?:all{S}+copies|this{S}+(?:message|e-?mail))",
        rf"unauthorized{S}+(?:use|disclosure|distribution){S}+is{S}+(?:prohibited|strictly)",
        rf"notify{S}+the{S}+(?:sender|author){S}+immediately",
    )
) + ")"

def entries(*lines: str) -> str:
    """The entries as alternatives, in their order; a blank in an entry stands for one or more blanks, ``_*`` for any number."""
    return "|".join(x.replace("_*", f"{S}*").replace(" ", f"{S}+") for x in lines)


# fixed values: words that keep a disclaimer going (whole words); only blanks and word boundaries are written
# for both engines
DISCLAIMER_VOCABULARY = LB + "(?:" + entries(
    "confidential|privileged|proprietary|classified",
    "unauthorized|unintended|intended recipient",
    "prohibited|strictly prohibited|illegal|unlawful",
    "please (?:delete|destroy|notify|disregard)",
    "notify the sender|contact the sender",
    "all copies|this (?:message|email|communication|transmission)",
    "(?:disclosure|dissemination|distribution|copying) (?:is|are|of this)",
    "virus|malware|scanned|security software",
    "legal|legally binding|attorney|solicitor|counsel|jurisdiction",
    "tax advice|regulated (?:activity|firm)|financial conduct|authority",
) + ")" + RB
# fixed values: closing formulas (the whole stripped line)
SALUTATIONS = f"^{S}*(?:" + entries(
    "best_*(?:regards?|wishes?)?",
    "kind regards?",
    "warm regards?",
    "regards?",
    "sincerely",
    "cheers",
    "(?:thanks?|thank you) (?:again|a lot|so much|a bunch|a ton|very much|in advance|for everything)",
    "many thanks(?: again)?",
    "thanks?",
    "thank you",
    "yours? (?:truly|faithfully|sincerely)?",
    "speak soon",
    "talk soon",
    "chat soon",
    "catch up soon",
    "looking forward(?: to (?:hearing|connecting|speaking|chatting))?",
    "have a (?:great|good|wonderful|nice) (?:day|week|weekend)",
    "all the best",
    "with (?:regards?|appreciation|gratitude)",
    "cordially",
    "respectfully",
    "faithfully",
    "(?:thanks?|thank you) and (?:best )?(?:regards?|wishes?)",
    "with thanks and (?:best )?(?:regards?|wishes?)",
    "thank you for (?:your )?(?:time|support|understanding|help|patience)",
) + rf"){S}*[,.!]?{S}*$"
# fixed values: a closing formula that goes on in its line
INLINE_SIGNATURE = f"^{S}*(?:" + entries(
    "best",
    "regards?",
    "thanks?",
    "thank you",
    "cheers",
    "sincerely",
    "warm regards?",
) + rf"){S}*[,.]{S}*\*{{0,2}}[a-z]"
# fixed values: footers of mail programs (the whole line)
FOOTERS = f"^{S}*(?:" + entries(
    "sent from (?:my )?(?:iphone|ipad|android|samsung|blackberry|galaxy|pixel|huawei|oneplus|xiaomi|motorola|nokia)",
    "get (?:outlook|gmail) for (?:ios|android)",
    "sent from (?:outlook|yahoo mail|mail) for (?:windows|mac|ios|android)",
    "sent from (?:protonmail|zoho mail|aol mail|thunderbird)",
    "sent via (?:yahoo|zoho|aol)",
    rf"\[cid:{A}*\]",
) + f"){S}*$"
# fixed values: contact lines; the first group minds case, the second does not
CONTACT_CASED = "|".join(
    (
        rf"{LB}\d{{3}}[{WS}\-.]\d{{3}}[{WS}\-.]\d{{4}}{RB}",
        rf"\+\d[\d{WS}\-().]{{6,}}",
        rf"\*\+?\d[\d{WS}\-().]{{5,}}\*",
        rf"{LB}[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}{RB}",
        rf"https?://{NS}+",
    )
)
CONTACT = "|".join(
    (
        rf"{LB}www\.[a-z0-9\-]+\.[a-z]{{2,}}",
        r"linkedin\.com|twitter\.com|facebook\.com",
        LB + "(?:" + entries(
            "vp|svp|evp|ceo|cto|cmo|cfo|coo|cio|ciso",
            "director|manager|president|chairman",
            "analyst|consultant|consulting|engineer|executive|specialist",
            "architect|coordinator|administrator|advisor|advisory",
            "representative|strategist|evangelist|principal",
            "account executive|customer success|sales engineer",
            "solutions? (?:architect|engineer|consultant)",
            "technical (?:lead|director|manager|advisor)",
            "enterprise (?:architect|consultant|representative)",
        ) + ")" + RB,
        LB + "(?:suite|ste|floor|blvd|ave|road|drive)" + RB,
        LB + "(?:inc|llc|ltd|corp|co|gmbh|plc|pvt|pte)" + RB,
    )
)
# fixed values: header fields of quoted mails
HEADER_FIELDS = rf"^[{WS}>]*\*{{0,2}}(?:from|sent|to|cc|bcc|subject|date|von|gesendet|an|betreff|datum|de|envoyé|à|objet|enviado|para|asunto|fecha|data)\*{{0,2}}{S}*:"
ON_WROTE = rf"^[{WS}>]*on{S}+{A}{{5,180}}{S}+wrote{S}*:{S}*$"
FORWARDED = rf"^[{WS}>]*-{{3,}}{S}*(?:original|forwarded){S}+message{S}*-{{3,}}"
HEADER_LINE = f"(?:{HEADER_FIELDS}|{ON_WROTE}|{FORWARDED})"
ADDRESS = r"[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}"
HTML = rf"<(?:html|body|div|p|br|span|table|a){RB}"
# fixed values: phrases of automated mail, in order of priority
WEAK_LABELS: dict[str, tuple[str, ...]] = {
    "ooo": (
        "out of office", "out-of-office", "automatic reply", "autoreply", "i am currently out of the office",
        "i will respond upon my return", "limited access during this time", "replies delayed",
    ),
    "newsletter": ("unsubscribe", "manage preferences", "newsletter", "digest", "view in browser"),
    "system": ("automated message", "do not reply", "delivery failure", "undeliverable", "mailer-daemon", "generated automatically"),
    "ai_generated": ("generated by ai", "meeting notes"),
}
