"""Literals found by the names that they are assigned to, form by form."""

import time

import pytest

from setgraph.llm.secret_scan import literal_score, scan_text

S = "Zx81-qq7!Lm2"


def literals(text):
    return [text[a:b] for a, b, k in scan_text(text) if k == "literal"]


@pytest.mark.parametrize("text", [
    f"const dbPwd = `{S}`;",
    f"db_pwd = b'{S}'",
    f"db_pwd = r'{S}'",
    f'db_pwd = f"{S}"',
    f'string pwd = @"{S}";',
    f'#define DB_PWD "{S}"',
    f"#define DB_PWD {S}\n",
    f'db_pwd = """{S}"""',
    f"db_pwd = '''{S}'''",
    f'<add key="db_pwd" value="{S}"/>',
    f"FROM x\nENV DB_PWD {S}\nRUN y",
    f"ENV DB_PWD={S}",
    f'setenv("DB_PWD", "{S}")',
    f"define('DB_PWD', '{S}');",
    f"user, db_pwd = 'bobby-tables', '{S}'",
    f"db_pwd = ('{S}')",
    f"db_pwd += '{S}'",
    f"DB_PWD ?= {S}",
    f"CREATE USER bob IDENTIFIED BY '{S}';",
    f"db_pwd:\n  prod: {S}\nuser:\n  prod: someone-else1\n",
    f"db_pwds:\n  - {S}\n".replace("pwds", "pwd"),
    f"keys = ['{S}']\npassphrase = keys[0]",
    f"db_pwd = os.getenv('SOME_LONG_NAME') or '{S}'",
    f"const pwd = process.env.LONG_NAME_9 || '{S}';",
    f"db_pwd = (\n    '{S}'\n)\ntitle = 'aB3dE5fG7hJ9'",
    f"a = db_pwd = '{S}'",
    f"- name: DB_PWD\n  value: {S}\n",
    f'{{"db_pwd": {{"prod": "{S}", "user_name": "aB3dE5fG7hJ9"}}, "title": "aB3dE5fG7hJ9"}}',
    f"connect(host='example.org9', pwd='{S}', port=1)",
    f"mysql --db-pwd {S} --host aB3dE5fG7hJ9",
    "db_pwd: Annotated[" + "Some, " * 40 + f"str] = '{S}'",
    f"private Map<String, String> pwd = '{S}';",
    f"It isn't done: db_pwd = '{S}' isn't safe",
    f"```python\ndb_pwd = '{S}'\n```",
    f"db_pwd = '{S}' # not \"this",
    f"connect(it, pwd='{S}')",
    f"as was said, db_pwd = '{S}' and more, or less1234 of it, aB3dE5fG7hJ9",
    f"err, db_pwd = unseal('{S}')",
])
def test_form(text):
    assert literals(text) == [S]


@pytest.mark.parametrize("text", [
    "db_pwd = os.getenv('Zx81-qq7!Lm2')", "pwd = your-value-here", "pwd = '<insert Zx81 here>'", "if db_pwd == 'Zx81-qq7!Lm2':",
    "token_limit = 'Zx81-qq7!Lm2'", "db_pwd = load_it(x)\ntitle = 'Zx81-qq7!Lm2'", "label = 'x'\n(unclosed pwd = (\n\n'Zx81-qq7!Lm2'",
    "db_pwd: ask\n\nThe title is 'Zx81-qq7!Lm2'.", "", "'", '"""', "{[(<", "}])>", "a:\n", "= = =", "- - -",
])
def test_no_form(text):
    assert literals(text) == []


def test_phrases_and_values_that_begin_with_your():
    assert literals("passphrase = 'correct horse battery staple'") == ["correct horse battery staple"]
    assert literals("passphrase = 'yourT9xk2Qq'") == ["yourT9xk2Qq"]
    assert literal_score("Please enter your password") == 0.0


@pytest.mark.parametrize("part", ["(", "f(a=", "{'a': ", "[", '"', "'", '\\"', '"""\\', "`x", "<a ", "a, ", "a = ", "a:\n ", "${a", "pwd = (", "- "])
def test_any_text_takes_linear_time(part):
    def seconds(n):
        t0 = time.process_time()
        scan_text("pwd = " + part * n)
        return time.process_time() - t0
    seconds(1000)
    assert seconds(40_000) < 20 * max(seconds(4_000), 0.05)
