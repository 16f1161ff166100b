"""Assignment forms that the secret lexer reads, and texts whose naive folding would be exponential or quadratic."""

import time

import pytest

from cairnflow.llm import secrets


def literals(text):
    return [text[a:b] for kind, a, b in secrets.secret_spans(text)[1] if kind == "literal"]


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ('password: str = "Xk39fLq0Zr71"', ["Xk39fLq0Zr71"]), ('passwd: Optional[Dict[str]] = "Xk39fLq0Zr71"', ["Xk39fLq0Zr71"]), ('config["db_password"] = "Xk39fLq0Zr71"', ["Xk39fLq0Zr71"]),
        ('os.environ["API_TOKEN"] = "Xk39!fLq0Zr71"', ["Xk39!fLq0Zr71"]), ('private_key =\n    "Xk39fLq0Zr71"', ["Xk39fLq0Zr71"]), ('private_key = (\n  "Xk39fL"\n  "q0Zr71zz"\n)', ["Xk39fL", "q0Zr71zz"]),
        ('db_pass = "Xk39fL" + \\\n "q0Zr71zz"', ["Xk39fL", "q0Zr71zz"]), ("private_key: |\n  MIIEvQIBADANBgkqh9\n  kG9w0BAQEFAASCBKcw\nother: 1", ["MIIEvQIBADANBgkqh9", "kG9w0BAQEFAASCBKcw"]),
        ("b:\n  private_key: >-\n    MIIEvQIBADANBgkqh9\n  c: 2", ["MIIEvQIBADANBgkqh9"]), ('signing_key = """Xk39fLq0Zr71"""', ["Xk39fLq0Zr71"]), ("signing:\n  name: Xk39fLq0Zr71aa\n", []),
        ('auth_key == "Xk39fLq0Zr71"', []), ('f(private_key="Xk39fLq0Zr71", other=1)', ["Xk39fLq0Zr71"]), ('signing_key = "' + "aB1" * 40 + '"', ["aB1" * 40]), ('signing_key = "${' + "aB1" * 40 + '}"', []),
        ('signing_key = "' + "x" * 90 + '"', []),
    ],
)
def test_forms(text, found):
    assert literals(text) == found


def test_constants_built_from_constants_are_folded_without_copies():
    doubled = 'a0="Xk39fLq0Zr71"\n' + "".join(f"a{n + 1} = a{n} + a{n}\n" for n in range(300)) + "signing_key = a300"
    assert literals(doubled) == ["Xk39fLq0Zr71"]
    chain = 'a0="Xk3"\n' + "".join(f'a{n + 1} = a{n} + "x{n}Q"\n' for n in range(2000)) + "signing_key = a2000"
    assert len(literals(chain)) == 2001


@pytest.mark.parametrize("text", ['x="' + '\\"' * 100_000, 'x="""\\' * 40_000, "x=\n" * 50_000, "a:b[ " * 40_000, "x=(" * 40_000, "=" * 100_000, "password: aaaabbbb9 " * 20_000, "x=\\\n" * 40_000])
def test_time_grows_with_the_text(text):
    start = time.perf_counter()
    secrets.secret_spans(text)
    assert time.perf_counter() - start < 20


def test_strength_of_a_summary_is_that_of_the_text():
    text = 'x = "aB3$" + "zz9Q"'
    (_, literal), = secrets.pairs(text)
    assert secrets.strength(*literal.summary(text)) == secrets.literal_strength("aB3$zz9Q")
