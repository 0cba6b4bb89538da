"""Sentences with marked personal information, made by rule, on which the field of ``llm/personal.py`` is fitted.

Words, people and numbers are invented; patterns of numbers are those of public numbering plans. Every
sentence is a list of parts, a part being plain text or ``(kind, text)``.
"""

from __future__ import annotations

import random

Part = str | tuple[str, str]

_SYL = "ba ce di fo gu ka le mi no pu ra se ti vo zu ler man sen tor vik dal ner wick".split()
GIVEN = tuple("Anna Boris Clara Dario Emma Felix Greta Hugo Ida Jonas Klara Leo Mara Nils Olga Paul Rosa Sven Tilda Viktor".split())
FAMILY = tuple("Abend Birkner Corvin Dahlke Ellrich Farnow Gessler Hollin Ivarsen Jorden Kessel Lindau Morven Norrby Ostwald Perrin Quast-Abend Renner Sollin-Ivarsen Tarnow Lindau-Hollin".split())
PEOPLE = tuple((g, f) for i, f in enumerate(FAMILY) for g in (GIVEN[i % len(GIVEN)], GIVEN[(i * 7 + 3) % len(GIVEN)]))


class Maker:
    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)

    def word(self, n: int = 2) -> str:
        return "".join(self.r.choice(_SYL) for _ in range(n))

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def noun(self) -> str:
        return self.r.choice("basket bottle carpet curtain drum engine fence glove hammer kettle ladder mirror needle oven pillow rope saddle towel vase wagon".split())

    def shape(self, pattern: str) -> str:
        return "".join(self.r.choice("0123456789") if c == "9" else self.r.choice("ABCDEFGHJKLMNPRSTXZ") if c == "A" else c for c in pattern)

    def name(self) -> str:
        g, f = self.r.choice(PEOPLE)
        k = self.r.random()
        out = f"{g} {f}" if k < 0.45 else f"{f}, {g}" if k < 0.55 else f"{f} {g}" if k < 0.65 else f"{g[0]}. {f}" if k < 0.8 else f"{f}, {g[0]}." if k < 0.87 else f"{g} {self.r.choice('BDKM')}. {f}"
        return out.upper() if self.r.random() < 0.08 else out.lower() if self.r.random() < 0.04 else out

    def email(self) -> str:
        user, host = f"{self.word()}{self.r.choice(['.', '_', '', '-'])}{self.word(1)}", f"{self.word()}.{self.r.choice(['example', 'test', 'invalid'])}"
        k = self.r.random()
        if self.r.random() < 0.2:
            user, host = (user.upper(), host.upper()) if self.r.random() < 0.6 else (user.title(), host.title())
        if k < 0.75:
            return f"{user}@{host}"
        spell = lambda x: x.replace(".", " dot ")
        return f"{user} [at] {host}" if k < 0.83 else f"{user}(at){host}" if k < 0.88 else f"{spell(user)} at {spell(host)}"

    def phone(self) -> str:
        return self.shape(self.r.choice("+99 9999 999999;+1 999 999 9999;+1-999-999-9999;+99 9 99 99 99 99;+99 99 99999 999;+9999999999999;0099-99-99999-999;0099 99 99999 999;(999) 999-9999;(099) 99999-999;999-999-9999;999.999.9999;099 9999 9999;09999 999 999;09.99.99.99.99;09 99 99 99 99;1-999-999-9999;+99 (0)999 999999".split(";")))

    def number(self) -> str:
        """An identity number."""
        return self.shape(self.r.choice("999-99-9999;999 99 9999;999999999;AA 99 99 99 B;AA999999C;AA9999999;A9999999;9999 9999 9999;9999-9999-9999;99 999 999 999;99999999999;99999999A;999.999.999-99".split(";")))

    def address(self) -> str:
        n, w = self.r.randrange(1, 999), self.word().capitalize()
        unit = self.r.choice(["", "", "a", "b", " c"])
        return self.r.choice(
            [f"{n}{unit} {w} {k}" for k in "Street St Road Rd Lane Avenue Ave Drive Crescent Terrace Court Close Blvd Way Square Blvd. Ave. St. Blvd. Rd.".split()]
            + [f"{n} {self.r.choice('NSEW')} {w} Road", f"{n}, rue {w}", f"{n} bis rue des {w}s", f"{n}, avenue de {w}", f"{n} place {w}", f"{n}, bd. de la {w}", f"{n}, place {w}"]
            + [f"{w}straße {n}{unit}", f"{w}weg {n}", f"Am {w}platz {n}", f"Hohe {w}gasse {n}{unit}", f"{w}str. {n}", f"{w}allee {n}", f"Unter den {w} {n}"]
            + [f"Calle {w} {n}", f"Avenida de {w}, {n}", f"Rua do {w}, {n}", f"Plaza {w} {n}", f"Via {w} {n}", f"Piazza del {w} {n}", f"Av. {w} {n}"]
        )

    def made(self, template: str) -> list[Part]:
        out: list[Part] = []
        for k, x in enumerate(template.split("|")):
            if k % 2 == 0:
                if x:
                    out.append(x)
            elif x in _KINDS:
                out.append((_KINDS[x], getattr(self, x)()))
            elif x == "noun":
                out.append(self.noun())
            elif x == "place":
                out.append(self.word().capitalize())
            elif x == "given":
                out.append(self.r.choice(GIVEN))
            elif x == "family":
                out.append(self.r.choice(FAMILY))
            elif x in ("asphone", "asid"):  # the shape of one, but of a thing
                out.append(self.phone() if x == "asphone" else self.number())
            elif x.startswith("="):
                out.append(self.shape(x[1:]))
            else:
                out.append(self.r.choice(x.split("/")))
        return out


_KINDS = {"name": "person_name", "email": "email", "phone": "phone", "number": "id_number", "address": "street_address"}
_IDS = "SSN/social security number/passport/passport no./passport number/NI number/national insurance number/citizen number/tax number/tax ID/Steuer-ID/Reisepass/passeport/pasaporte/DNI/NIF/CPF/identity number"
_THINGS = "article no./order no./order/invoice/invoice no./batch/serial no./part no./lot/slot/row/barcode/version/build/code/case/ticket/ref./door/room/account/claim no./page/number/no."
TEMPLATES: tuple[str, ...] = (
    "Please write to |email| before noon.", "|email|", "e-mail: |email|", "ask |name| or |email|", "Schreiben Sie an |email|.", "écrivez à |email|, merci", "mande um e-mail para |email| hoje", "to |email|, cc |email|", "|email|, |email| and |email|", "|email| or |phone|", "write to |name| (|email|) or |name| (|email|)", "the list goes to |email|; the |noun| goes to |address|.",
    "T |phone|", "Tel. |phone|", "Tel: |phone|", "Phone |phone|", "Mobile: |phone|", "M |phone|", "Fax |phone|", "|phone|", "call |phone| first", "You can ring |name| on |phone|.", "reach me at |phone| or |email|",
    "Sie erreichen |name| unter |phone|.", "vous pouvez joindre |name| au |phone|", "llame al |phone| mañana", "fale com |name| pelo |phone|", "my new mobile is |phone|", "contact |name|, |phone|.", "office |phone| ext. 4", "T |phone| M |phone|", "|phone|, |phone|", "|phone| or |phone|", "llamar a |name| al |phone| o escribir a |email|", "ring |name| on |phone| or write to |email|", "joindre |name| au |phone| ou écrire à |email|", "|name| unter |phone| oder |email|",
    f"my |{_IDS}| is |number|", f"the |{_IDS}| |number| was read twice", f"|{_IDS}|: |number|", f"|{_IDS}| |number|", f"We still need your |{_IDS}| |number| for the |noun|.", f"|name|, |{_IDS}| |number|", f"document: |{_IDS}| |number|.",
    "the parcel goes to |address|, Suite 4, |place|", "|address|", "|address|, 12345 |place|", "She moved to |address| in spring.", "send it to |name|, |address|, |place|", "wir ziehen in die |address| um", "il habite |address|, |place|",
    "la oficina está en |address|", "our shop in |address| is open", "|address|, floor 2", "|address|", "|address|", "it goes to |address|.", "it goes to |address|, |place| |place|.", "|address|; |address|", "|address| or |address|", "|name| moved to |address| in May", "la lettre est pour |name|, |address|, |place|, merci", "|name|, |address|; |noun|: |number|", "|address|", "|address|", "bring the |noun| to |address| and call |phone|.",
    "|name|", "|name| will take the |noun|.", "ask |name| about it", "Is it with |name| or with |name|?", "- |name|", "Regards, |name|", "der Schlüssel liegt bei |name|", "le dossier de |name| est prêt", "nobody but |name| knows", "|name| and |given| met",
    # told by no word: now and then one, mostly not
    "|number|", "so, |number| it is", "|given| wrote |number| again.", *["|asid|", "so, |asid| it is", "|given| wrote |asid| again."] * 3,
    # nothing
    "|given| has the |noun|.", "THE |noun| IS GONE", "|family| and |given| sent it", "the |family| building is closed", "Dear |given|,", "Thanks, |given|",
    f"the |noun| bears |{_THINGS}| |asphone|", f"the |noun| bears |{_THINGS}| |asid|", f"|{_THINGS}| |asphone|", f"|{_THINGS}|: |asid|", f"|{_THINGS}| |=999999| and |{_THINGS}| |=9999.999.99|.", f"it has |{_THINGS}| |=999-9999|", f"|{_THINGS}| |=9999 999 9999| of the list",
    "the address is |=192.0.2.99| today", "we counted |=9,999,999| and |=999999| of them", "|=99.99.9999| at noon", "on |=9999-99-99| and |=99/99/9999|", "a total of |=999,999.99| was paid for |=99| units", "from |=9999| to |=9999| |noun|s", "EAN |=9999999999999| printed",
    "|=99999999999999999999|", "the sum was |=999999999| in the end", "Message-ID: <|email_like|>",
    "there are |=99| |noun|s close to the wall", "It took |=9| days to drive there", "we paid |=99| for the |noun| and left", "|=9| people on the way to |place|", "Room |=9| |noun| way is shut", "row |=9| of the street plan", "am Montag |=99| Uhr",
    "im Mai |=9999| war der Weg |=9| frei", "on page |=99| the road ends", "|=9| of the square boxes", "unter den |=99| Kisten", "we saw |=9| court cases", "via |place| in |=9| hours", "the |=99| lane road", "a |=99| way of doing things", "Weg |=9| und Tor |=9|",
    "please treat the |noun| as it is", "the |noun| of |place| is at the |place| office", "look at |place| dot and line", "meet at noon or at |=9|",
)


def samples(n: int, seed: int = 5) -> list[list[Part]]:
    """``n`` sentences; every template is used about equally often."""
    m = Maker(seed)
    out = []
    for i in range(n):
        t = TEMPLATES[i % len(TEMPLATES)]
        if "email_like" in t:
            out.append([f"Message-ID: <{m.digits(2)}.{m.word()}@{m.word()}.example>"])
            continue
        parts = m.made(t)
        if m.r.random() < 0.4:  # two sentences on a line
            parts = [*parts, m.r.choice([" ", "; ", " - "]), *m.made(m.r.choice([x for x in TEMPLATES if "email_like" not in x]))]
        out.append(parts)
    return out


def repeated(n: int, seed: int = 6) -> list[list[list[Part]]]:
    """``n`` texts of lines in which a number is told once by a label and stands alone elsewhere."""
    m = Maker(seed)
    out = []
    for i in range(n):
        personal = i % 2 == 0
        value = m.number()
        told = m.made(f"my |{_IDS}| is ") if personal else m.made(f"the |noun| bears |{_THINGS}| ")
        part: Part = ("id_number", value) if personal else value
        lines: list[list[Part]] = [[*told, part, m.r.choice([".", " now"])]]
        for _ in range(m.r.randrange(1, 4)):
            lines.append([m.r.choice(["", "so ", "it was ", "again "]), part, m.r.choice(["", ".", " once more"])])
        m.r.shuffle(lines)
        out.append(lines)
    return out
