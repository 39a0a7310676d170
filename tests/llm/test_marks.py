import random
import re

from tidegauge.llm import dac

#: The rule as stated: a mark that ends a word, after a plain letter or digit.
RULE = re.compile(r"(?<=[0-9A-Za-zÀ-ÖØ-öø-ɏ])([.,!?;:])(?=[ \n]|\Z)")


def test_marks_are_cut_by_the_rule_and_searched_for_first():
    draw = random.Random(5)
    texts = ["".join(draw.choices("aZ0é×÷ɏ日.,!?;: \n\r", k=draw.randint(0, 12))) for _ in range(20000)]
    assert all(dac._MARK.sub(r" <\1", t) == RULE.sub(r" <\1", t) for t in texts)
    assert dac._MARK.pattern.startswith("([.,!?;:])")
