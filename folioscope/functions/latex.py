"""LaTeX source as plain text: a tokenizer, and a table of what commands make of their arguments.

Texts are read once from left to right. Groups are kept on a stack, so nesting may be of any depth. Arguments of known commands are
collected as already converted text; commands that the table doesn't know keep what they stand for: their arguments, or without any their name.
"""

from __future__ import annotations

import re
import unicodedata

# Accent commands and the names of their combining characters.
ACCENTS = {
    "`": "GRAVE ACCENT", "'": "ACUTE ACCENT", "^": "CIRCUMFLEX ACCENT", '"': "DIAERESIS", "~": "TILDE", "=": "MACRON", ".": "DOT ABOVE",
    "u": "BREVE", "v": "CARON", "H": "DOUBLE ACUTE ACCENT", "c": "CEDILLA", "k": "OGONEK", "r": "RING ABOVE", "d": "DOT BELOW", "b": "MACRON BELOW",
    "hat": "CIRCUMFLEX ACCENT", "tilde": "TILDE", "bar": "MACRON", "vec": "RIGHT ARROW ABOVE", "dot": "DOT ABOVE", "ddot": "DIAERESIS",
}
# Greek letters by name; capitals begin with a capital.
GREEK = frozenset("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split())
# Commands that stand for a character or some.
SYMBOLS = {
    "ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "aa": "å", "AA": "Å", "i": "ı", "j": "ȷ", "dh": "ð", "th": "þ",
    "S": "§", "P": "¶", "copyright": "©", "pounds": "£", "euro": "€", "dots": "…", "ldots": "…", "cdots": "⋯", "times": "×", "pm": "±", "mp": "∓", "div": "÷",
    "leq": "≤", "le": "≤", "geq": "≥", "ge": "≥", "neq": "≠", "ne": "≠", "approx": "≈", "sim": "∼", "equiv": "≡", "propto": "∝", "infty": "∞", "to": "→",
    "rightarrow": "→", "leftarrow": "←", "Rightarrow": "⇒", "leftrightarrow": "↔", "in": "∈", "notin": "∉", "subset": "⊂", "subseteq": "⊆", "cup": "∪", "cap": "∩",
    "emptyset": "∅", "forall": "∀", "exists": "∃", "sum": "∑", "prod": "∏", "int": "∫", "partial": "∂", "nabla": "∇", "cdot": "·", "circ": "∘", "ast": "∗",
    "degree": "°", "textdegree": "°", "textmu": "µ", "ell": "ℓ", "hbar": "ℏ", "dagger": "†", "bullet": "•", "textbullet": "•", "varepsilon": "ε", "vartheta": "ϑ", "varphi": "φ",
    "textbackslash": "\\", "textasciitilde": "~", "textasciicircum": "^", "textendash": "–", "textemdash": "—", "textquoteright": "’", "textregistered": "®", "texttrademark": "™",
    "LaTeX": "LaTeX", "TeX": "TeX", "quad": " ", "qquad": " ", "newline": "\n", "par": "\n\n", "item": "\n* ", "&": "&", "%": "%", "$": "$", "#": "#", "_": "_", "{": "{", "}": "}",
    ",": " ", ";": " ", ":": " ", " ": " ", "!": "", "/": "", "-": "", "\\": "\n", "left": "", "right": "", "big": "", "Big": "", "limits": "", "displaystyle": "", "noindent": "", "centering": "",
    "maketitle": "", "newpage": "", "bf": "", "it": "", "em": "", "rm": "", "sc": "", "tt": "", "small": "", "large": "", "sin": "sin", "cos": "cos", "log": "log", "exp": "exp", "max": "max", "min": "min",
}
# What commands make of their arguments, in order.
COMMANDS = {
    "frac": ("{0}/{1}", 2), "dfrac": ("{0}/{1}", 2), "tfrac": ("{0}/{1}", 2), "binom": ("({0} over {1})", 2), "sqrt": ("√({0})", 1), "href": ("{1} <{0}>", 2), "textcolor": ("{1}", 2), "colorbox": ("{1}", 2),
    "cite": ("<cit.>", 1), "citep": ("<cit.>", 1), "citet": ("<cit.>", 1), "ref": ("<ref>", 1), "eqref": ("(<ref>)", 1), "label": ("", 1), "footnote": ("[{0}]", 1), "includegraphics": ("", 1),
    "input": ("", 1), "bibliography": ("", 1), "bibliographystyle": ("", 1), "usepackage": ("", 1), "documentclass": ("", 1), "vspace": ("", 1), "hspace": (" ", 1), "phantom": ("", 1), "multicolumn": ("{2}", 3),
    "section": ("\n\n{0}\n", 1), "subsection": ("\n\n{0}\n", 1), "paragraph": ("\n\n{0} ", 1), "caption": ("\n{0}\n", 1), "overline": ("{0}̄", 1), "textsuperscript": ("^{0}", 1), "textsubscript": ("_{0}", 1),
}
#: Environments whose content is left out, and those that stay as they are written.
DROPPED, RAW = frozenset(("comment",)), frozenset(("verbatim", "lstlisting"))

TOKEN = re.compile(
    r"(?P<comment>%[^\n]*\n?[\x20\t]*)|\\(?P<begin>begin|end)\s*\{(?P<env>[^{}]*)\}|\\(?P<name>[A-Za-z]+)\*?[\x20\t]*\n?[\x20\t]*|\\(?P<mark>[^A-Za-z])|(?P<open>\{)|(?P<close>\})"
    r"|(?P<math>\$\$?)|(?P<dash>---?)|(?P<quote>``|'')|(?P<tie>~)|(?P<tab>&)|(?P<optional>\[)|(?P<text>[^\\{}$~&%`'\[-]+|.)",
    re.DOTALL,
)
ARGUMENT = re.compile(r"\s*\{")


class _Frame:
    """A group or a command that waits for arguments."""

    __slots__ = ("command", "wanted", "arguments", "out")

    def __init__(self, command: str | None = None, wanted: int = 0):
        self.command, self.wanted, self.arguments, self.out = command, wanted, [], []


def _accented(command: str, text: str) -> str:
    base = {"ı": "i", "ȷ": "j"}.get(text[:1], text[:1]) or " "
    return unicodedata.normalize("NFC", base + unicodedata.lookup(f"COMBINING {ACCENTS[command]}")) + text[1:]


def _made(frame: _Frame) -> str:
    """What a command and its arguments stand for."""
    if frame.command in ACCENTS:
        return _accented(frame.command, frame.arguments[0])
    shape, count = COMMANDS.get(frame.command, ("".join(f"{{{i}}}" for i in range(len(frame.arguments))), 0))
    return shape.format(*frame.arguments, *[""] * count)


def latex_to_text(source: str | None) -> str | None:
    """Plain text of a LaTeX source; null stays null, and unbalanced groups end with the text."""
    if source is None:
        return None
    stack, at, n, maths = [_Frame()], 0, len(source), False

    def emit(text: str) -> None:
        """Text to the innermost frame; as an argument, if a command without braces waits for one."""
        while stack[-1].command is not None and stack[-1].wanted > len(stack[-1].arguments):
            if not text.strip() and text:
                return  # spaces before an argument
            stack[-1].arguments.append(text[:1])
            rest = text[1:]
            if len(stack[-1].arguments) < stack[-1].wanted:
                if not rest:
                    return
                text = rest
                continue
            made = _made(stack.pop())
            emit(made)
            if rest:
                emit(rest)
            return
        stack[-1].out.append(text)

    while at < n:
        m = TOKEN.match(source, at)
        kind, at = m.lastgroup, m.end()
        if kind == "env":
            if m["begin"] == "begin" and (m["env"] in DROPPED or m["env"] in RAW):
                end = source.find(f"\\end{{{m['env']}}}", at)
                end = n if end < 0 else end
                emit("" if m["env"] in DROPPED else source[at:end])
                at = min(n, end + len(m["env"]) + 6)
            else:
                emit("\n")
                if m["begin"] == "begin" and m["env"].rstrip("*") in ("tabular", "array") and (given := re.compile(r"\s*\{[^{}]*\}").match(source, at)):
                    at = given.end()
        elif kind in ("name", "mark"):
            name = m[kind]
            spaced = " " if maths and m[0][-1].isspace() else ""  # in text, spaces behind a command's name only end it
            if name in "()[]" and len(name) == 1:
                maths = name in "(["
                emit(" " if name in "[]" else "")
            elif name in ACCENTS:
                stack.append(_Frame(name, 1))
            elif name in SYMBOLS:
                emit(SYMBOLS[name] + spaced)
            elif name.lower() in GREEK and name[1:].islower():
                letter = unicodedata.lookup(f"GREEK {'CAPITAL' if name[0].isupper() else 'SMALL'} LETTER {name.upper().replace('LAMBDA', 'LAMDA')}")
                emit(letter + spaced)
            else:
                if optional := re.compile(r"\s*\[[^\[\]]*\]").match(source, at):
                    at = optional.end()
                if name in COMMANDS:
                    stack.append(_Frame(name, COMMANDS[name][1]))
                elif not ARGUMENT.match(source, at):
                    emit(name + " ")  # an unknown command without arguments
        elif kind == "open":
            stack.append(_Frame())
        elif kind == "close":
            while len(stack) > 1 and stack[-1].command is not None:  # a command without all its arguments
                frame = stack.pop()
                stack[-1].out.append(_made(frame) if frame.arguments else "")
            if len(stack) > 1:
                text = "".join(stack.pop().out)
                waiting = stack[-1]
                if waiting.command is not None:
                    waiting.arguments.append(text)
                    if len(waiting.arguments) == waiting.wanted:
                        emit(_made(stack.pop()))
                else:
                    waiting.out.append(text)
        elif kind == "math":
            maths = not maths
            emit(" " if m["math"] == "$$" else "")
        elif kind not in ("comment",):
            emit({"---": "—", "--": "–", "``": "“", "''": "”", "~": " ", "&": " "}.get(m[0], m[0]))
    while len(stack) > 1:
        frame = stack.pop()
        emit("".join(frame.out) if frame.command is None else _made(frame) if frame.arguments else "")
    paragraphs = re.split(r"[\x20\t]*\n[\x20\t]*\n\s*", "".join(stack[0].out))
    return "\n".join(x for x in (" ".join(p.split()) for p in paragraphs) if x)
