import pytest

from faultline.llm import main_text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ('<p class="a"">Hello</p>', "Hello"),
        ('<p title="x>One', "One"),
        ("<p onclick='x>Two</p><p>Three</p>", "Two\nThree"),
        ('<p a=b"c>Four</p>', "Four"),
        ('<p title="a>b" id=x>Five</p>', "Five"),
        ("<img alt=x/>Six<p a = \"q>r\">Seven", "Six\nSeven"),
    ],
)
def test_stray_quotes_stay_in_their_tag(page, text):
    assert main_text.main_text(page) == text


def test_many_open_quotes_end():
    page = "<p>text</p>" + "<p a='" * 20_000 + '<p a="' * 20_000 + "=  " * 20_000
    assert main_text.main_text(page).startswith("text")
