"""Operators on small inputs, with edge rows."""

from pyspark.sql import functions as F

from lodestone.functions import globs, paths, rules, text
from lodestone.operators import conversations, documents, graph, ledger, parsing, reflection, results, security, snapshots, tasks
from lodestone.sources import readers, writers
from lodestone.streaming import stateful


def col(df, name="x"):
    return [r[name] for r in df.collect()]


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("x")).first()["x"]


APP = "def calculate(value):\n    return value\n"
TEST = "from app import calculate\n\ndef test_it():\n    assert calculate(1) == 1\n"
USERS = "from fastapi import FastAPI\napp = FastAPI()\n\n@app.get('/users/{user_id}')\ndef get_user(user_id):\n    return 1\n\nclass User(Base):\n    pass\n"


def sources(spark, files):
    return spark.createDataFrame([(p, 1, len(t), bytearray(t.encode())) for p, t in files.items()], "path string, mtime_ns bigint, size bigint, content binary")


def test_repository_graph(spark):
    files = parsing.parse_files(sources(spark, {"app.py": APP, "tests/test_app.py": TEST, "src/users.py": USERS, "bad.py": "def ("})).cache()
    assert [r.path for r in graph.find_symbols(files, "calculate").collect()] == ["app.py"]
    assert graph.find_callers(files, "calculate").first()["path"] == "tests/test_app.py"
    assert col(graph.impacted_tests(files, spark.createDataFrame([("app.py",)], "path string")), "path") == ["tests/test_app.py"]
    assert graph.routes(files).first()["route"] == "GET /users/{user_id}"
    assert graph.models(files).first()["model"] == "User"
    assert graph.summary(files).first()["parse_errors"] == 1
    assert col(graph.frameworks(files), "framework") == ["FastAPI"]
    dep = graph.dependencies(files, "app.py").first()
    assert dep["imported_by"] == ["tests/test_app.py"] and dep["imports"] == []
    assert graph.relevance(files, "user route").first()["path"] == "src/users.py"
    assert graph.find_symbols(files, "  ").count() == 0


def test_other_languages():
    got = parsing.parse_other("import x from './lib/a'\nclass A {}\nconst f = (a) => 1\napp.get('/x', g)\nmongoose.model('M')", "a.ts", "typescript")
    assert got["imports"] == ["./lib/a", "x"] and [s["name"] for s in got["symbols"]] == ["A", "f"]
    assert got["routes"] == ["GET /x"] and got["database_models"] == ["M"]
    assert parsing.parse_other("CREATE TABLE IF NOT EXISTS t (a int)", "a.sql", "sql")["database_models"] == ["t"]


def test_incremental_refresh(spark):
    files = {"a.py": "x = 1\n", "b.py": "y = 2\n"}
    old = parsing.parse_files(sources(spark, files))
    listing = sources(spark, {"a.py": "x = 1\n", "b.py": "y = 22\n", "c.py": ""})
    stats = snapshots.refresh_stats(snapshots.refresh_plan(old, listing)).first()
    assert (stats.scanned, stats.indexed, stats.reused, stats.removed) == (3, 2, 1, 0)
    new = snapshots.refresh(old, listing, parsing.parse_files)
    assert sorted(col(new, "path")) == ["a.py", "b.py", "c.py"]
    gone = snapshots.update_paths(old, listing.limit(0).transform(parsing.parse_files), spark.createDataFrame([("a.py",)], "path string"))
    assert col(gone, "path") == ["b.py"]
    empty = old.limit(0)
    assert snapshots.refresh_stats(snapshots.refresh_plan(empty, empty)).first()["scanned"] == 0


def test_policy(spark):
    rule = spark.createDataFrame([("allow", "write", "src/**"), ("deny", "write", "src/generated/**"), ("ask", "network_access", "*")], "decision string, capability string, pattern string")
    req = spark.createDataFrame([(1, "write", "src/app.py"), (2, "write", "src/generated/api.py"), (3, "deploy", ""), (4, "network-access", None)], "id int, capability string, target string")
    assert {r.id: r.decision for r in rules.decide(req, rule).collect()} == {1: "allow", 2: "deny", 3: "ask", 4: "ask"}
    parsed, defaults = readers.policy_rules(spark, "defaults:\n  read: allow\nallow:\n  - write:src/**\ndeny:\n  - write:src/x\n")
    assert parsed.count() == 2 and defaults == {"read": "allow"}


def test_safety(spark):
    level = lambda c, **k: one(spark, c, lambda v: rules.command_safety(v, **k)["label"])
    assert [level(c) for c in ("ls -la", "rm -rf /", "DELETE FROM t", "delete from t where x", "git push")] == ["safe", "blocked", "dangerous", "safe", "warn"]
    assert level("make x", blocked=["make"]) == "blocked" and level("rm -rf a", allowed=["rm"]) == "dangerous"
    assert one(spark, 'api_key = "abcdefghijklmnopqrstu1"', rules.secret_labels)[0] == "API key"
    assert one(spark, "/etc/passwd", lambda v: rules.file_write_safety(v)["label"]) == "blocked"


def test_requests(spark):
    df = spark.createDataFrame([("build a new app",), ("fixé un test",), ("hello",), ("",), (None,)], "text string")
    got = rules.classify_requests(df).collect()
    assert [r.intent for r in got] == ["build", "test", "chat", "unknown", "unknown"]
    assert got[0].plan_type == "direct" and got[4].difficulty == "trivial"
    assert one(spark, "Operation timed out", rules.failure_kind) == "timeout"


def test_paths(spark):
    assert one(spark, "a/b/test_x.py", paths.is_test) and not one(spark, "contest.py", paths.is_test)
    assert one(spark, ".github/x.yml", paths.is_configuration)
    assert sorted(one(spark, "pkg/__init__.py", paths.module_names)) == ["__init__", "pkg", "pkg.__init__", "pkg/__init__"]
    assert one(spark, "a/b.c", lambda v: globs.matches(v, "a*c")) and not one(spark, "a/b.d", lambda v: globs.matches(v, "*.c"))
    assert one(spark, "file1", lambda v: globs.matches(v, "file[!2-9]"))
    assert one(spark, "/w/a", lambda v: paths.is_inside(v, F.lit("/w"))) and not one(spark, "/wx", lambda v: paths.is_inside(v, F.lit("/w")))
    assert one(spark, "..", paths.is_identifier) is False


def test_owners(spark):
    rule = graph.codeowners(spark.createDataFrame([("# c\nsrc/** @backend\n*.md @docs @x\n",)], "text string"))
    files = spark.createDataFrame([("src/users.py",), ("a/b.md",), ("z",)], "path string")
    assert {r.path: r.owners for r in graph.owners(files, rule).collect()} == {"src/users.py": ["@backend"], "a/b.md": ["@docs", "@x"], "z": []}


def test_text(spark):
    assert one(spark, "Fix the auth_token bug and auth_token", text.query_terms) == ["auth_token", "bug"]
    assert one(spark, "<p>a&amp;b <script>x</script>\n c</p>", text.html_to_text) == "a&b c"
    assert one(spark, "see `src/a.py` and next.js, ./b.ts", text.file_names) == ["src/a.py", "b.ts"]
    assert one(spark, "x\n❌ (exit code 3)\n", text.exit_code) == 3 and one(spark, "✅ $ ls", text.exit_code) == 0
    assert one(spark, "token=abc sk-12345678", text.redact_credentials) == "token=[REDACTED] [REDACTED_CREDENTIAL]"
    assert one(spark, "a\r\nb\n", text.lines) == ["a", "b"]
    assert one(spark, "a\nb\nc", lambda v: text.edit_lines(v, F.lit(2), F.lit(2), F.lit("x"))) == "a\nx\nc"
    assert one(spark, "All tests passed", text.claims_success)


def test_drift_and_trust(spark):
    e = spark.createDataFrame([("1", "file_mutation", "c", [("a", True, "one", 1)]), ("2", "command", "c", []), ("3", "note", "c", None)], "id string, kind string, claim string, artifacts array<struct<path:string,`exists`:boolean,sha256:string,size:bigint>>")
    now = spark.createDataFrame([("a", "two")], "path string, sha256 string")
    assert {r.id: r.verdict for r in snapshots.drift(e, now).collect()} == {"1": "FAIL", "2": "RERUN_REQUIRED", "3": "RECORDED"}
    ok = spark.createDataFrame([("a", "one", True)], "path string, sha256 string, approved boolean")
    assert snapshots.trust(now, ok).first()["state"] == "CHANGED"


def test_tasks(spark):
    steps = spark.createDataFrame([(1, 1, "a", [], "FAILED"), (1, 2, "b", [1], "PENDING"), (1, 3, "c", [2], "PENDING"), (1, 4, "d", [], "PENDING")], "plan_id int, id int, title string, depends_on array<int>, status string")
    assert col(tasks.ready(steps), "id") == [4]
    blocked = lambda **k: {r.id: r.status for r in tasks.block_orphans(steps, **k).collect()}
    assert blocked()[3] == "PENDING" and blocked(transitive=True)[3] == "BLOCKED"
    loop = spark.createDataFrame([(1, 1, [2]), (1, 2, [1]), (1, 3, [9])], "plan_id int, id int, depends_on array<int>")
    assert {(r.id, r.problem) for r in tasks.problems(loop).collect()} == {(1, "cycle"), (2, "cycle"), (3, "unknown_dependency")}
    assert tasks.context(steps).first()["next"] == "d"
    # long chains: no limit of rounds
    chain = spark.createDataFrame([(1, i, [i - 1] if i else [], "PENDING" if i else "FAILED") for i in range(60)], "plan_id int, id int, depends_on array<int>, status string").coalesce(1)
    assert tasks.problems(chain).count() == 0
    short = chain.where("id < 9")
    assert {r.status for r in tasks.block_orphans(short, transitive=True).where("id > 0").collect()} == {"BLOCKED"}


def test_tables_that_must_match(spark):
    hidden = [".env", ".gitignore", ".eslintrc", ".prettierrc", "a.py", ".hidden", "x.svg", "node_modules/a.js", "a/.venv/b.py", "a/target/b.rs", "env/a.py", "x.DOCX", ".github/a.yml"]
    got = spark.createDataFrame([(p,) for p in hidden], "path string").where(paths.is_hidden(F.col("path"))).collect()
    assert [r.path for r in got] == hidden[5:]
    shown = ["a.pem", "a/b.py", "credentials", "x.env"]
    secret = ["credentials.json", "a/ID_DSA", "id_ecdsa", "id_rsa", ".env", ".env.local", "x/.aws/config", ".git/config", "home/.ssh/known", ".npmrc"]
    got = spark.createDataFrame([(p,) for p in shown + secret], "path string").where(paths.is_sensitive(F.col("path"))).collect()
    assert [r.path for r in got] == secret
    f = spark.createDataFrame([(p, 'password = "abcdefgh1"') for p in ["a.c", "a.kt", "a.sh", "a.ini", "Makefile", "x/Dockerfile", "a.md", "a.txt"]], "path string, text string")
    assert sorted(r.path for r in security.scan(security.scannable(f)).collect()) == ["Makefile", "a.c", "a.ini", "a.kt", "a.sh", "x/Dockerfile"]
    f = spark.createDataFrame([("a.py", f'password = "{v}-value-1"') for v in ["change-me", "fake", "sample", "test", "real"]], "path string, text string")
    assert security.scan(f).count() == 1
    verdict = lambda u: one(spark, u, security.url_verdict)
    assert {verdict(f"http://{h}/") for h in ("metadata.goog", "metadata.azure.com", "metadata.oraclecloud.com", "metadata.google.internal", "192.0.0.192", "100.100.100.200")} == {"metadata"}
    assert one(spark, "http://10.0.0.1/", lambda u: security.redirect_verdict(F.lit("https://a.com"), u)) == "redirect_private_range"
    assert one(spark, "http://a.com/", lambda u: security.redirect_verdict(F.lit("https://a.com"), u)) is None
    allowed = [one(spark, x, security.content_type_allowed) for x in ("image/png", "text/html; charset=x", "Application/X-Dosexec; a", "application/x-sharedlib", "application/x-executable")]
    assert allowed == [True, True, False, False, False]


def test_conversations(spark):
    m = spark.createDataFrame([(1, i, "user" if i % 2 == 0 else "assistant", f"m{i} " + "x" * 300) for i in range(40)] + [(2, 0, "user", "é"), (2, 1, "assistant", None)] + [(3, 0, "assistant", "q")], "conv_id int, turn int, role string, text string")
    got = conversations.compact(m, keep=4).where("conv_id = 1").orderBy("turn").collect()
    assert len(got) == 6 and "CONVERSATION SUMMARY" in got[0].text and got[-1].text.startswith("m39")
    assert conversations.compact(m, keep=10).where("conv_id = 2").count() == 2
    assert {r.conv_id: r.preview for r in conversations.previews(m).collect()}[3] == "(empty conversation)"
    c = spark.createDataFrame([("r", 1, "he", None, None, None), ("r", 2, "llo", 0, "id", '{"a"'), ("r", 3, None, 0, None, ":1}"), ("r", 4, None, 1, None, "x")], "request string, seq int, content string, tool_index int, tool_id string, fragment string")
    r = conversations.reassemble(c).first()
    assert r.text == "hello" and [(x.id, x.arguments) for x in r.calls] == [("id", '{"a":1}'), ("call_1", "x")]


def test_results(spark):
    schema = "task_id string, category string, status string, duration_ms bigint, agent_status string, model_calls int, prompt_tokens bigint, completion_tokens bigint, estimated_cost_usd double"
    df = spark.createDataFrame([("task-1", "bug", "PASSED", 1000, "x", 1, 100, 50, 0.02), ("task-2", "bug", "FAILED", 500, "x", 1, 150, 0, 0.03)], schema)
    k = results.dashboard(df).first()
    assert (k.tasks, k.success_percent, k.seconds) == (2, 50.0, 1.5) and abs(k.cost_usd - 0.05) < 1e-9
    zero = results.summary(df.limit(0)).first()
    assert zero.tasks == 0 and zero.success_rate == 0.0
    m = spark.createDataFrame([('{"schema_version":"1","id":"s","tasks":[{"id":"a","category":"bug-repair","verification":[[]]},{"id":"a","category":"odd"}]}',), ("nope",)], "text string")
    assert {r.problem for r in results.manifest_problems(m).collect()} == {"not_json", "empty_command", "category", "duplicate_id"}


def test_budget(spark):
    calls = spark.createDataFrame([("s", 1, 50), ("s", 2, 80), ("s", 3, 40), ("s", 4, None), ("s", 5, -3)], "k string, seq bigint, prompt_tokens bigint")
    got = [r.accepted for r in results.budget_gate(calls, "k", "seq", 3, 100).orderBy("seq").collect()]
    assert got == [True, False, True, True, False]


def test_reflection(spark):
    rows = [("s", 0, "run", "ok")] + [("s", i, "run", "❌ odd") for i in range(1, 4)] + [("s", 4, "run", "❌ ImportError"), ("s", 5, "run", "⚠️ x")]
    got = [r.verdict for r in reflection.verdicts(spark.createDataFrame(rows, "session string, seq int, tool string, output string")).orderBy("seq").collect()]
    assert got == ["SUCCESS", "RETRY", "RETRY", "ESCALATE", "RETRY", "ESCALATE"]


def test_security(spark):
    f = spark.createDataFrame([("app.py", 'x = 1\npassword = "s3cr3t-value-1"\nh = md5(x)\n'), ("b.py", 'token = "your_token_here"'), ("README.md", "password"), ("tests/t.py", 'secret = "abcdefgh1"')], "path string, text string")
    got = {(r.path, r.kind, r.line) for r in security.scan(security.scannable(f)).collect()}
    assert got == {("app.py", "hardcoded-credential", 2), ("app.py", "weak-hash", 3)}
    assert security.scan_verdict(security.scan(security.scannable(f))).first()["verdict"] == "FAILED"
    verdict = lambda u: one(spark, u, security.url_verdict)
    assert [verdict(u) for u in ("https://a.com/x", "file:///x", "http://169.254.169.254/", "http://localhost:1", "http://192.168.0.1", "http://", "http://224.0.0.1")] == [None, "blocked_scheme", "metadata", "loopback", "private_range", "empty_host", "multicast"]
    m = spark.createDataFrame([("requirements.txt", "flask>=1\n# c\n-r x\n"), ("package.json", '{"dependencies":{"react":"1"}}'), ("Cargo.toml", '[package]\nname = "x"\n[dependencies]\nserde = "1"\n'), ("go.mod", "require (\n a/b v1\n)\nrequire c/d v2\n")], "path string, text string")
    assert {(r.registry, r.name) for r in security.manifest_packages(m).collect()} == {("pypi", "flask"), ("npm", "react"), ("crates", "serde"), ("go", "a/b"), ("go", "c/d")}
    c = spark.createDataFrame([(1, "pip install -r x flask==1 ./local"), (2, "npm i @a/b@2"), (3, "echo 'x")], "id int, command string")
    assert {(r.registry, r.name) for r in security.install_commands(c).collect()} == {("pypi", "flask"), ("npm", "@a/b")}


def test_ledger(spark, tmp_path):
    lines = spark.createDataFrame([("s", '{"a":1}'), ("s", "{bad"), ("t", '{"b":2}'), ("t", "")], "session_id string, value string")
    assert ledger.replay(lines).count() == 2 and col(ledger.evidence_trail(lines), "session_id") == ["t"]
    runs = spark.createDataFrame([("s1", "turn-1", "RUNNING", "1"), ("s1", "turn-2", "DONE", "3"), ("s2", "turn-1", "FAILED", "2")], "session_id string, turn_id string, status string, updated_at string")
    pick = lambda x: [(r.session_id, r.turn_id) for r in ledger.resolve_run(runs, x).collect()]
    assert [pick(x) for x in ("", "s1", "s2/turn-1", "turn-2", "turn-1", "../x")] == [[("s1", "turn-2")], [("s1", "turn-2")], [("s2", "turn-1")], [("s1", "turn-2")], [], []]
    writers.append_json_lines(spark.createDataFrame([("k", 1), ("k", 2)], "k string, n int"), str(tmp_path / "e"), "ev", "k", ["n"])
    assert sorted(col(spark.read.json(str(tmp_path / "e")), "id")) == ["ev-000001", "ev-000002"]


def test_sources(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "node_modules").mkdir()
    (tmp_path / "src/a.py").write_text(APP)
    (tmp_path / "src/b.txt").write_text("no")
    (tmp_path / "node_modules/c.js").write_text("x")
    tree = readers.source_tree(spark, str(tmp_path))
    assert col(tree, "path") == ["src/a.py"]
    st = spark.createDataFrame([(" M a.py\nR  b.py -> c.py\n?? a.py\n",)], "text string")
    assert col(readers.git_status(st), "path") == ["a.py", "c.py"]
    assert readers.git_log(spark.createDataFrame([("h\ta\td\ts\tt\nx\n",)], "text string")).first()["subject"] == "s\tt"


def test_documents(spark):
    f = spark.createDataFrame([("R.md", "# Title\n## Safety\n- rm -rf\n## Notes\n* be kind\nlang: python\n")], "path string, text string")
    got = documents.markdown_sections(f).withColumn("k", documents.rule_kind(F.col("section")))
    assert [(r.kind, r.k, r.item) for r in got.orderBy("line").collect()] == [("item", "blocked_command", "rm -rf"), ("item", "convention", "be kind"), ("directive", "convention", "lang: python")]
    assert documents.directives(f).first()["value"] == "python"
    e = documents.exact_edits(spark.createDataFrame([(1, "a b a", "b", "x"), (2, "a b a", "a", "x"), (3, "q", "z", "y")], "id int, text string, old string, new string"))
    assert {r.id: (r.after, r.found) for r in e.collect()} == {1: ("a x a", 1), 2: ("a b a", 2), 3: ("q", 0)}
    d = documents.unified_diffs(spark.createDataFrame([("f", "a\n", "b\n")], "path string, before string, after string")).first()["diff"]
    assert "-a" in d and "+b" in d
    assert documents.search(f.withColumn("path", F.lit("src/R.md")), "KIND").first()["line"] == 5


def test_model_outputs(spark):
    df = spark.createDataFrame([(1, '<FILES>\nx\n</FILES>'), (2, '```json\n[{"description":"d","files":["a"]}]\n```'), (3, "free text")], "id int, text string")
    assert {r.id: r.files for r in parsing.tagged_output(df).select("id", "files").collect()} == {1: "x", 2: None, 3: None}
    got = {r.id0: r.id for r in parsing.task_list(df.withColumnRenamed("id", "id0"), "id0").collect()}
    assert got == {1: "task-1", 2: "task-1", 3: "task-1"}
    out = spark.createDataFrame([(1, 'x\n{"a":1}\n{"b":2}\n{oops')], "id int, text string")
    assert parsing.last_json_object(out, "id").first()["json"] == '{"b":2}'


def test_state_machine_batch_and_stream(spark, tmp_path):
    seq = ["planning", "idle", "executing", "completed", "executing", "idle"]
    df = spark.createDataFrame([("r", i, s) for i, s in enumerate(seq)], "run string, seq bigint, to_state string")
    batch = [(r.seq, r.legal, r.state) for r in stateful.run_states(df).orderBy("seq").collect()]
    assert [x[1] for x in batch] == [True, False, True, True, False, True]
    df.coalesce(1).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).json(str(tmp_path / "in"))
    q = stateful.run_states_stream(stream).writeStream.format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert [(r.seq, r.legal, r.state) for r in spark.table("states").orderBy("seq").collect()] == batch


def test_key_rotation(spark):
    r = spark.createDataFrame([("p", 1, 0.0, True), ("p", 2, 1.0, False), ("p", 3, 2.0, False), ("p", 4, 90.0, False)], "pool string, seq bigint, ts double, limited boolean")
    assert [x.key for x in stateful.rotate_keys(r, ["a", "b"]).orderBy("seq").collect()] == ["a", "b", "b", "a"]


def test_agents(spark):
    from lodestone.operators import agents

    t = spark.createDataFrame([(1, "do it", "vague", 1), (2, "write two json files", "multi_file", 2), (3, "add a database thread", "atomic", 1), (4, "small", "atomic", 1)], "id int, description string, scope_level string, expected_files int")
    assert [(r.route, r.reason) for r in agents.route_tasks(t).orderBy("id").collect()] == [("hosted", "underspecified"), ("hosted", "multi-file json"), ("hosted", "high-risk: thread, database"), ("local", "atomic")]
    s = spark.createDataFrame([("web", 0, ["react", "css"], ["*.tsx"], ["build"], 80), ("db", 1, ["sql"], [], [], 50)], "skill string, ordinal int, keywords array<string>, file_patterns array<string>, intents array<string>, priority int")
    i = spark.createDataFrame([(1, "React css sql", "a/B.tsx", "Build"), (2, "nothing", "", "")], "id int, text string, path string, intent string")
    got = agents.skill_scores(i, s).collect()
    assert [(r.id, r.skill, round(r.score, 4), r.rank) for r in got] == [(1, "web", 0.8, 1), (1, "db", 0.125, 2)]
    g = spark.createDataFrame([(1, "atomic", 1, 1, False, ["f"], "def f(): pass"), (2, "atomic", 2, 1, False, [], ""), (3, "multi_file", 2, 1, False, [], ""), (4, "atomic", 1, 1, False, ["g"], "x")], "id int, scope_level string, expected_files int, actual_files int, answered boolean, expected_names array<string>, output string")
    assert [r.verdict for r in agents.guardrail(g).orderBy("id").collect()] == ["PASS", "REJECT_SCOPE", "REJECT_FILE_COUNT", "REJECT_FUNC_NAME"]
    p = spark.createDataFrame([("a", "package.json"), ("a", "tsconfig.json"), ("b", "x"), ("c", "go.mod")], "project string, path string")
    assert {r.project: r.type for r in agents.project_types(p).collect()} == {"a": "typescript", "b": "unknown", "c": "go"}
    assert one(spark, "class A:\n  pass\ndef f():\n  pass", lambda v: agents.file_summary(F.lit("x.py"), v)) == "4 lines | python | classes: A | functions: f"
    assert one(spark, "f( {", lambda v: agents.truncation_reason(F.lit("a.ts"), v)).startswith("unbalanced {}") and one(spark, "f(')')", lambda v: agents.truncation_reason(F.lit("a.ts"), v)) is None
    # one very long quote, closed and not: no repetition may recurse by character
    long = "x\\n" * 200_000
    assert one(spark, f"f('{long}')", lambda v: agents.truncation_reason(F.lit("a.ts"), v)) is None
    assert one(spark, f"f('{long}", lambda v: agents.truncation_reason(F.lit("a.ts"), v)).startswith("unbalanced ()")
    c = agents.acceptance_criteria(spark.createDataFrame([(1, "fix the bug")], "id int, text string")).first()
    assert c.verification[0].startswith("Run the project") and len(c.criteria) == 7
    m = spark.createDataFrame([("big-model", "Big Model", 0), ("small", "Small One", 1)], "key string, title string, ordinal int")
    a = spark.createDataFrame([("s", "small")], "alias string, key string")
    n = spark.createDataFrame([("S",), ("big",), ("one",), ("zz",), ("",)], "name string")
    assert {r.name: r.key for r in agents.resolve_alias(n, m, a, "big-model").collect()} == {"S": "small", "big": "big-model", "one": "small", "zz": None, "": "big-model"}
    arr = spark.createDataFrame([([1, 3, 5], 3), ([1, 3, 5], 4), ([], 1)], "a array<int>, t int")
    assert [r.x for r in arr.select(agents.sorted_position(F.col("a"), F.col("t")).alias("x")).collect()] == [1, -1, -1]
    r = spark.createDataFrame([("t", 1, True, ["a"], [], ["f"], 2), ("t", 2, False, ["b"], ["e"], ["f", "g"], 3)], "team string, seq int, succeeded boolean, findings array<string>, errors array<string>, files array<string>, calls int")
    x = agents.team_report(r, "team").first()
    assert (x.agents, x.passed, x.findings, x.errors, x.files, x.calls) == (2, 1, ["a", "b"], ["e"], 2, 5)
    assert one(spark, '{"usage":{"prompt_tokens":3}}', agents.usage_of).asDict() == {"prompt_tokens": 3, "completion_tokens": 0}
    h = agents.content_hash(spark.createDataFrame([("p", 1, "a", bytearray(b"x")), ("p", 2, "b", bytearray(b"y"))], "key string, seq int, path string, content binary"), "key").first()
    import hashlib

    assert h.sha256 == hashlib.sha256(b"xy").hexdigest()


def test_labels_by_their_beginnings(spark):
    import random
    import re
    import time

    rng = random.Random(1)
    some = ["a", "Z9", "_", ".", "-", " ", "\n", "é", "--..", "x" * 40, "." * 90, "\u2028", "\r\n"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(14))) for _ in range(1500)] + ["a" * 158 + "-.-!", "a" * 159 + "!" * 9 + ".b", "!" + "a" * 160 + "?", None]
    df = spark.createDataFrame(enumerate(texts), "i int, text string")
    want = [None if x is None else re.sub(r"^[-.]+|[-.]+\Z", "", re.sub(r"[^A-Za-z0-9_.-]+", "-", x))[:160] for x in texts]
    assert [r.x for r in df.select("i", text.label_name(F.col("text")).alias("x")).orderBy("i").collect()] == want
    long = spark.createDataFrame([(("a" + "-" * 50_000) * 6 + "b",)], "text string")
    begin = time.monotonic()  # the square of a run of dashes
    assert long.select(text.label_name(F.col("text")).alias("x")).first().x == "a" + "-" * 159
    assert time.monotonic() - begin < 4


def test_only_entities_go_through_python(spark):
    import random
    from html import unescape

    rng = random.Random(2)
    some = ["&amp;", "&lt", "&#65;", "&#x41", "&notit;", "&", ";", "&#", "&#xD800;", "é&eacute;", "&unknown;", "x" * 40, "&" + "y" * 40, "&#0;", "&&amp;#38;", "&#1114112;", "&ampx"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(9))) for _ in range(800)]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "i int, html string").select("i", text.html_to_text(F.col("html")).alias("x"))
    assert [r.x for r in df.orderBy("i").collect()] == [None, *[unescape(x) for x in texts]]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython [decode(regexp_extract_all(" in plan
