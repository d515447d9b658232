"""Values that repeat in the text, and contexts that follow one another."""

import time

from enrollspark.llm import secrets as S

VALUE = "9fKdmQxeLpZ7vR2"


def guessed(text):
    return [text[s:e] for k, s, e, _ in S.scan(text) if k == "guess"]


def test_a_copy_of_a_value_does_not_make_it_guessable():
    for t in (f"auth={VALUE} is used here", f"see db://root:{VALUE}@host now"):
        assert guessed(t) == [VALUE]
        for copy in (VALUE, f"({VALUE})", f"{VALUE}/x", f"x-{VALUE}", VALUE[1:11]):
            assert guessed(f"{t} {copy} again") == [VALUE]
    # the words of prose still count
    assert not guessed("Elephantine walls, GRANITE: pwd=elephantinegranite1")


def test_bearer_needs_no_separator():
    for t in (f"Authorization: Bearer {VALUE}", f"auth: Bearer {VALUE}", f"bearer: {VALUE}", f"bearer = {VALUE}", f'"bearer" : "{VALUE}"'):
        assert guessed(t) == [VALUE]
        assert VALUE not in S.mask(t)
    assert not guessed("the bearer certificates and the Bearer self-evident were no use to a cupbearer whosoever1x")


def test_a_value_that_is_a_context_does_not_hide_the_next():
    for t in (f"pwd: token: {VALUE}", f"pwd: credentials = {VALUE}", f"auth: client_secret => pwd: passphrase: '{VALUE}'"):
        assert VALUE in [t[s:e].split(": ")[-1].strip("'") for _, s, e, _ in S.scan(t)]
        assert VALUE not in S.mask(t)
        assert (t.index(VALUE), t.index(VALUE) + len(VALUE)) in set(S.context_values(t))


def test_many_contexts_take_linear_time():
    at = time.process_time()
    S.scan("pwd:" * 20_000)
    S.scan("pwd: auth: " * 20_000)
    assert time.process_time() - at < 20
