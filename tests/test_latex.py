"""LaTeX source and the text that it stands for."""

import time

import pytest

from folioscope.functions.latex import latex_to_text

CASES = [
    (r"plain words", "plain words"), (r"\emph{a} $b$", "a b"), (r"\textbf{bold \textit{both}}", "bold both"), (r"caf\'e", "café"), (r"caf\'{e}", "café"), (r"na\"{\i}ve", "naïve"),
    (r"\v{S}koda \c{c}a \H{o}", "Škoda ça ő"), (r"Erd\H os", "Erdős"), (r"\~n \`a \^o \=u \.z", "ñ à ô ū ż"), (r"Stra\ss e", "Straße"), (r"\O rsted and \AE sir", "Ørsted and Æsir"),
    (r"$\alpha + \beta \leq \Gamma$", "α + β ≤ Γ"), (r"$\lambda$-calculus", "λ-calculus"), (r"$\frac{a}{b}$", "a/b"), (r"\frac{\frac{1}{2}}{x}", "1/2/x"), (r"$\frac12$", "1/2"), (r"$x^2 + y_i$", "x^2 + y_i"),
    (r"$x^{2n}$", "x^2n"), (r"$\sqrt{x+1}$", "√(x+1)"), (r"\sqrt[3]{8}", "√(8)"), (r"5\,\% of \$3 \& more \#1", "5 % of $3 & more #1"), (r"a~b", "a b"), (r"pages 3--5 --- end", "pages 3–5 — end"),
    (r"``quoted''", "“quoted”"), ("before % a note\nafter", "before after"), (r"50\% kept", "50% kept"), (r"see \cite{x,y} and \ref{f}", "see <cit.> and <ref>"), (r"text\label{sec:a}.", "text."),
    (r"\href{http://a.b}{site}", "site <http://a.b>"), (r"\textcolor{red}{warn}", "warn"), (r"word\footnote{note}", "word[note]"), (r"\section{Title} body", "Title body"), ("one\n\ntwo", "one\ntwo"),
    (r"\begin{itemize}\item a\item b\end{itemize}", "* a * b"), (r"\begin{tabular}{ll} a & b \\ c & d \end{tabular}", "a b c d"), (r"\begin{comment}no\end{comment}yes", "yes"), (r"\begin{verbatim}\raw{x}\end{verbatim}", r"\raw{x}"),
    (r"\unknown{kept}", "kept"), (r"\unknown[opt]{a}{b}", "ab"), (r"a \mystery word", "a mystery word"), (r"$10\times 10^{-3}$", "10× 10^-3"), (r"\(x\) and \[y\]", "x and y"), (r"{\bf heavy}", "heavy"), (r"\LaTeX{} rules", "LaTeX rules"),
    (r"open {group", "open group"), (r"closed} group", "closed group"), (r"\'", ""), ("", ""), (r"\hat{x} \vec{v}", "x̂ v⃗"), (r"it's fine", "it's fine"), ("a [b] c", "a [b] c"),
]


@pytest.mark.parametrize("source, expected", CASES, ids=[c[0][:30] or "empty" for c in CASES])
def test_text(source, expected):
    assert latex_to_text(source) == expected


def test_null_depth_and_cost():
    assert latex_to_text(None) is None
    assert latex_to_text("{" * 20_000 + "x" + "}" * 20_000) == "x"

    def cost(n):
        began = time.process_time()
        latex_to_text(r"\emph{a $\frac{\alpha}{2}$} \'e {\bf b} [x] -- " * n)
        return time.process_time() - began

    cost(100)
    assert cost(8_000) < 8 * cost(2_000) + 0.2
