"""Display forms of source titles and of assessments from older schemas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Commands that have a character of their own.
GREEK = (
    "alpha α beta β gamma γ delta δ epsilon ϵ varepsilon ε zeta ζ eta η theta θ vartheta ϑ iota ι kappa κ "
    "lambda λ mu μ nu ν xi ξ pi π rho ρ sigma σ tau τ upsilon υ phi φ varphi φ chi χ psi ψ omega ω "
    "Gamma Γ Delta Δ Theta Θ Lambda Λ Xi Ξ Pi Π Sigma Σ Upsilon Υ Phi Φ Psi Ψ Omega Ω"
)
SIGNS = "times × cdot · pm ± mp ∓ to → rightarrow → leftarrow ← infty ∞ ell ℓ hbar ℏ leq ≤ geq ≥ neq ≠ approx ≈ sim ∼ partial ∂ nabla ∇ otimes ⊗ oplus ⊕ dagger †"
SUBSCRIPTS = ("0123456789+-=()", "₀₁₂₃₄₅₆₇₈₉₊₋₌₍₎")
SUPERSCRIPTS = ("0123456789+-=()n", "⁰¹²³⁴⁵⁶⁷⁸⁹⁺⁻⁼⁽⁾ⁿ")


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pairs(text: str) -> dict[str, str]:
    words = text.split()
    return dict(zip(words[::2], words[1::2]))


def _convert(text: Column, mark: str, digits: tuple[str, str]) -> Column:
    """Raises or lowers the digits after a mark, alone or in braces."""
    token = f"\\{mark}(?:\\{{[{_inside(digits[0])}]+\\}}|[{_inside(digits[0])}])"
    found = F.regexp_extract_all(text, F.lit(token), F.lit(0))
    moved = F.transform(found, lambda t: F.translate(F.regexp_replace(t, f"[\\{mark}{{}}]", ""), *digits))
    parts = F.split(text, token, -1)
    return F.array_join(F.zip_with(parts, moved, lambda p, m: F.concat(F.coalesce(p, F.lit("")),
                                                                      F.coalesce(m, F.lit("")))), "")


def _inside(characters: str) -> str:
    return "".join("\\" + ch if ch in "+-=()" else ch for ch in characters)


def display_title(c: Column | str) -> Column:
    """A source title without formula markup; the stored title is untouched."""
    text = _column(c)
    for name, sign in {**_pairs(GREEK), **_pairs(SIGNS)}.items():
        text = F.regexp_replace(text, f"\\\\{name}(?![A-Za-z])", sign)
    text = F.regexp_replace(text, "\\\\(?:left|right)(?![A-Za-z])", "")
    text = F.regexp_replace(text, "\\\\[A-Za-z]+\\*?\\s*(?=\\{)", "")
    text = F.regexp_replace(text, "\\\\[A-Za-z]+\\*?", " ")
    text = F.regexp_replace(text, "(?<=[A-Za-z])\\{([A-Za-z]+)\\}|\\{([A-Za-z]+)\\}", "$1$2")
    text = _convert(_convert(text, "_", SUBSCRIPTS), "^", SUPERSCRIPTS)
    text = F.regexp_replace(text, "---", "—")
    text = F.regexp_replace(text, "--", "–")
    text = F.regexp_replace(text, "[${}\\\\]", "")
    text = F.regexp_replace(text, "\\s*×\\s*", " × ")
    return F.trim(F.regexp_replace(text, "\\s+", " "))


# Score recaps older assessments begin with or contain.
TOTAL_RECAP = "^総合(?:評定|評価|点)?\\s*[：:]?\\s*\\d{1,3}\\s*/\\s*100\\s*(?:[（(][^）)]*[）)])?\\s*[。：:、]?\\s*"
AXIS_RECAP = (
    "(^|[。！？]\\s*)(?:物理(?:学)?全体(?:への重要度・波及)?|(?:hep-th|gr-qc|quant-ph)内(?:の重要度・インパクト)?"
    "|カテゴリ|独創性|方法・結果(?:の説得力)?)\\s*\\d{1,2}\\s*(?:/\\s*25|点)\\s*[：:]\\s*"
)


def display_assessment(c: Column | str) -> Column:
    """An assessment without its leading total and per-axis points."""
    text = F.regexp_replace(_column(c), TOTAL_RECAP, "")
    return F.regexp_replace(text, AXIS_RECAP, "$1")
