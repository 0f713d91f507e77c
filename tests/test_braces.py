"""Functions and classes of brace languages: tables of spans by hand."""

import pytest

from graniteloom.operators import braces, chunker

JS = """import x from 'y'
// function no() {
export class Box extends Base {
  @keep
  async put(item, size = 1) {
    if (item) { this.items.push("}") }
    return this.put(item)
  }
}
const add = (a, b) => {
  const c = /[{/]/.test(a) ? a : b
  return `${c} {`
}
items.forEach((i) => {
  use(i)
})
function* walk(node) {
  for (const n of node) {
    yield n
  }
}
"""
JAVA = """package p;
public class Box<T> extends Base implements A, B {
  private final int size = 1;
  @Override
  public List<T> put(T item, int n) throws IOException {
    while (n > 0) { n--; }
    return f("{", '{');
  }
  Box(int n) {
    this.size = n;
  }
}
"""
GO = """package p
type Box struct {
  a int
}
func (b *Box) Put(x int) (int, error) {
  s := `{`
  return x, nil
}
func main() {
  go func() {
    f()
  }()
}
"""
RUST = """#[derive(Debug)]
pub struct P<'a> {
    x: &'a str,
}
impl<'a> P<'a> {
    pub fn get(&self, n: usize) -> usize {
        /* { /* nested */ { */
        match n { 0 => 1, _ => self.get(n - 1) }
    }
}
"""
C = """#define X(a) { \\
  a
static int *add(int a,
                int b) {
  if (a) { return 0; }
  return a + b;
}
"""
KOTLIN = """class A(val x: Int) : B() {
  fun go(n: Int): Int {
    val s = \"\"\"{\"\"\"
    return n
  }
}
"""
PHP = """<?php
class A {
  # {
  public function go($x) {
    return $x;
  }
}
"""
CSHARP = '''class A {
  public async Task<int> Go(int n) {
    var s = @"{""";
    return n;
  }
}
'''

TS = "export class A<T, U> {\n  private go<V>(x: number, y?: string): Map<string, V> {\n    return f(x)\n  }\n}\nexport const h = async (a: number): Promise<void> => {\n  await g(a)\n}\n"
CPP = "namespace n {\nclass A : public B {\n public:\n  A(int x) : x_(x) {\n    go();\n  }\n  int go() const {\n    return 'x';\n  }\n};\nint A::run(int n) {\n  for (;;) { }\n  return n;\n}\n}\n"
SWIFT = "class A: B, C {\n  init(x: Int) {\n    self.x = x\n  }\n  func go(_ n: Int) -> Int {\n    guard n > 0 else { return 0 }\n    return n\n  }\n}\n"
SCALA = "object A extends B with C {\n  def go(n: Int): Int = {\n    n + 1\n  }\n}\n"


@pytest.mark.parametrize("language,source,want", [
    ("typescript", TS, [("class", "A", 1, 5, ""), ("function", "go", 2, 4, "A"), ("function", "h", 6, 8, "")]),
    ("cpp", CPP, [("function", "A", 4, 6, "A"), ("function", "go", 7, 9, "A"), ("function", "run", 11, 14, "")]),
    ("swift", SWIFT, [("class", "A", 1, 9, ""), ("function", "init", 2, 4, "A"), ("function", "go", 5, 8, "A")]),
    ("scala", SCALA, [("class", "A", 1, 5, ""), ("function", "go", 2, 4, "A")]),
    ("javascript", JS, [("class", "Box", 3, 9, ""), ("function", "put", 4, 8, "Box"), ("function", "add", 10, 13, ""), ("function", "walk", 17, 21, "")]),
    ("java", JAVA, [("class", "Box", 2, 12, ""), ("function", "put", 4, 8, "Box"), ("function", "Box", 9, 11, "Box")]),
    ("go", GO, [("class", "Box", 2, 4, ""), ("function", "Put", 5, 8, ""), ("function", "main", 9, 13, "")]),
    ("rust", RUST, [("class", "P", 1, 4, ""), ("class", "P", 5, 10, ""), ("function", "get", 6, 9, "P")]),
    ("c", C, [("function", "add", 3, 7, "")]),
    ("kotlin", KOTLIN, [("class", "A", 1, 6, ""), ("function", "go", 2, 5, "A")]),
    ("php", PHP, [("class", "A", 2, 7, ""), ("function", "go", 4, 6, "A")]),
    ("csharp", CSHARP, [("class", "A", 1, 6, ""), ("function", "Go", 2, 5, "A")]),
])
def test_spans(language, source, want):
    assert [(c.chunk_type, c.symbol_name, c.start_line, c.end_line, c.enclosing_class) for c in braces.brace_chunks(source, language)] == want


def test_features():
    put, add = braces.brace_chunks(JS, "javascript")[1:3]
    assert put.call_tokens == ["this.items.push", "this.put"] and "branch" in put.control_flow_tags
    assert add.anonymized_code.startswith("FUNC_0 = (ARG_0, ARG_1) => {\n  const VAR_0") or "ARG_0" in add.anonymized_code
    assert "//" not in braces.plain("// a\nx = 'http://b' // c", "javascript").replace("http://", "")


@pytest.mark.parametrize("language", sorted(braces.LANGUAGES))
def test_broken_sources_end(language):
    for source in ["", "{", "}", "((", "/*", '"', "'", "`", "#", "class {", "f(", "x = {" * 50, "é{}\\", "R\"(", "\"\"\""]:
        assert isinstance(braces.brace_chunks(source, language), list)


def test_chunk_files_reads_brace_languages(spark):
    files = spark.createDataFrame([("r", "a.java", "java", JAVA), ("r", "b.rb", "ruby", "x\n" * 5), ("r", "c.go", "go", None)], "repo_id string, file_path string, language string, text string")
    got = {(r["file_path"], r["chunk_type"]) for r in chunker.chunk_files(files).collect()}
    assert got == {("a.java", "class"), ("a.java", "function"), ("b.rb", "line_window")}
