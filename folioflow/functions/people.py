"""Author names and the six citation styles over `array<array<string>>` name lists.

The forms are SQL text over the SQL of a name (`[surname, given]`) or of a list of names.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import let, literal, strip_sql


def names_sql(text: str) -> str:
    """`Surname, Given; Surname, Given` to [[surname, given], ...].

    A part that holds " and " is cut at every "and". A name without exactly one comma
    is kept whole as a one-item list.
    """
    pieces = f"if(contains(part, ' and '), transform(split(part, 'and'), x -> {strip_sql('x')}), array(part))"
    pair = let(
        "halves",
        f"split({strip_sql('name')}, ',')",
        f"if(size(halves) = 2, transform(halves, x -> {strip_sql('x')}), array(name))",
    )
    return f"transform(flatten(transform(split({text}, ';'), part -> {pieces})), name -> {pair})"


def parse_names(text: str) -> Column:
    return F.expr(names_sql(text))


def _given(name: str) -> str:
    return f"split({name}[1], ' ')"


def _whole(name: str, form: str) -> str:
    """Names of one part have no given name to shorten and stay as they are."""
    return f"if(size({name}) < 2, {name}[0], {form})"


def surname_given(name: str) -> str:
    return f"array_join({name}, ', ')"


def surname_given_initials(name: str) -> str:
    given = f"transform({_given(name)}, (g, i) -> if(i = 0, g, concat(left(g, 1), '.')))"
    return _whole(name, f"concat({name}[0], ', ', array_join({given}, ' '))")


def given_surname(name: str) -> str:
    return f"array_join(reverse({name}), ' ')"


def surname_initials(name: str) -> str:
    given = f"transform({_given(name)}, g -> concat(left(g, 1), '.'))"
    return _whole(name, f"concat({name}[0], ', ', array_join({given}, ' '))")


def surname_initials_plain(name: str) -> str:
    return _whole(name, f"concat({name}[0], ' ', array_join(transform({_given(name)}, g -> left(g, 1)), ' '))")


def _each(names: str, form) -> str:
    return f"transform({names}, n -> {form('n')})"


def _listed(forms: str, before_last: str) -> str:
    return let(
        "f", forms, f"concat(array_join(slice(f, 1, size(f) - 1), ', '), '{before_last}', element_at(f, -1))"
    )


def _stopped(text: str) -> str:
    return let("x", text, "if(x <> '' AND NOT endswith(x, '.'), concat(x, '.'), x)")


def _apa(names: str) -> str:
    listed = _listed(_each(names, surname_given_initials), ", and ")
    return _stopped(f"if(size({names}) = 1, {surname_given(names + '[0]')}, {listed})")


def _bibtex(names: str) -> str:
    return _stopped(f"array_join({_each(names, surname_initials)}, ' and ')")


def _up_to_three(names: str, more: str) -> str:
    first = given_surname(names + "[0]")
    return _stopped(
        f"""CASE WHEN size({names}) = 1 THEN {first}
                 WHEN size({names}) < 4 THEN {_listed(_each(names, given_surname), ' and ')}
                 ELSE concat({first}, '{more}') END"""
    )


def _chicago(names: str) -> str:
    return _up_to_three(names, " et al")


def _cse(names: str) -> str:
    return _stopped(f"array_join({_each(names, surname_initials_plain)}, ', ')")


def _mhra(names: str) -> str:
    return _up_to_three(names, " and others")


def _mla(names: str) -> str:
    first = surname_given(names + "[0]")
    forms = f"transform({names}, (n, i) -> if(i = 0, {surname_given('n')}, {given_surname('n')}))"
    text = f"""CASE WHEN size({names}) = 1 THEN {first}
                    WHEN size({names}) < 4 THEN {_listed(forms, ', and ')}
                    ELSE concat({first}, ', et al') END"""
    return let("x", text, "if(x <> '', concat(x, '.'), x)")


_FORMATS = {"apa": _apa, "bibtex": _bibtex, "chicago": _chicago, "cse": _cse, "mhra": _mhra, "mla": _mla}

STYLES = list(_FORMATS)


def cite(style: str, names: str, default_authors: str) -> Column:
    """Author list in one style; an empty list gives the site's default. `names` is SQL."""
    return F.expr(f"CASE WHEN size({names}) > 0 THEN {_FORMATS[style](names)} ELSE {literal(default_authors)} END")
