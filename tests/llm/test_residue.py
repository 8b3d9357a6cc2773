import pytest

from leafwork.llm import residue

CASES = [
    "__IMAGE.DESCRIPTION__", "<describe the image in one or two sentences> 27", "Add alt text here 5", "{{ title }}", "Dear {{name}}, please find it below.", "${image.description}", "#{figure.title} - cost", "<%= caption %>", "[[metric]]", "A photo. <<legend text>>", "@@TITLE@@ of the pump",
    "%%TITLE%%", "__CAPTION__", "$caption$ (2014)", "Figure {chart_type}: cost, {year}", "<Name> stands beside the <object>.", "[Insert description here]", "(your caption here)", "A box. [ADD UNIT]",
    "The ___ in X rose by ___ percent.", "Bar chart of XXX by YYY in 2013.", "The depot of NNN repairs is shown in XX percent.", "Title: [object Object]\nDescription: undefined", "undefined cost in null, NaN",
    "TBD - caption", "TODO: describe figure\nClick to add title", "{% block legend %}{% endblock %}", "{0} compared with {1} for 8 tickets", "%s by %s in Konil, %d", "[Bild hier beschreiben]",
    "Lorem ipsum dolor.", "Dummy text: a b c.", "text text text text te", "abc, abc, abc, abc", "Platzhaltertext, bitte ersetzen.", "Texte à compléter",
    "HTTP 404 - Not Found\nRequest id 2", "Error 500: Internal Server Error", "403 Forbidden", '{"error": {"code": 504, "message": "x"}}', "<html><head><title>429 Too Many Requests</title></head></html>",
    "This image could not be loaded. Try again later.", "Erreur 500 : le serveur a rencontré un problème.", "Diese Seite konnte nicht gefunden werden (Fehler 404).", "Traceback: connection reset",
    "Please enable JavaScript to view this content.", "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.", "Your session has expired.", "Access denied. You don't have permission.", "Checking your browser before you continue.", "Loading...",
    "{{ " + "image.description_of_the_figure_" * 3 + " }}", "Die Seite wurde nicht gefunden.", "Tu sesión ha caducado, vuelve a entrar.", "Forbidden: you lack the rights to see this file.", "Página no encontrada. Vuelva al inicio.", "Exemple de légende, à remplacer.",
    "La pagina richiesta non è stata trovata.", "Documento não encontrado.", "La session a expiré.", "The document you asked for could not be opened.", "You are not authorized to view this picture.", "Template: {{title}} {{unit}} explains {{year}}",
]
HONEST = [
    'The slide shows a template line "Dear {{name}}" inside a code editor.', "The formula {x | x > 7} stands above a map.", 'A to-do list on a whiteboard: "TODO: order meters".', "A mock-up of the page, filled with lorem ipsum as sample copy.",
    "Screenshot of a browser that shows a 404 page in blue.", 'The client retries after the gateway answers "502 Bad Gateway".', "A dialog asks the user to enable JavaScript; beneath it a button.", "Diagram of a form with 8 placeholder boxes.",
    "The map counts 500 and 503 responses per year; errors fell.", "A chart for 5 samples.", "Output widened by 45 percent [284] in 2012.", "Demand = 5x + 77", "See model R2O-91.", "A | 3 | 4", "Also listed: mill, mill, kiln, 22222222.",
    "Source: Login depot survey, 2023", "Growth of 37.5% (marked in red).", "An arrow -> points at x < 5 and y > 3.",
    "A page of documentation that explains how {{ user }} is written.", "Screenshot of a settings guide: the field {name} stands for the name of the user.", 'A poster quotes "' + "the mill was read twice before the committee met, " * 6 + 'then {{ name }} follows" beside a map.',
    "The slide shows 'Page not found' as a label beside the mill.", "The chart shows that 5 of 9 requests failed in 2012.", "A server rack and a service desk in a hall; neither is available to visitors.", "Das Diagramm zeigt die Seite der Halle, die nicht beheizt wird.",
]
NOTHING = [None, "", "  \n ", "(no description)"]


@pytest.fixture(scope="module")
def found(spark):
    data = [(k, t, "clash", "clash") for k, t in enumerate(CASES + HONEST + NOTHING)]
    df = spark.createDataFrame(data + data[:3], "doc int, description string, kinds string, word string")
    return {r.doc: r.kinds for r in residue.detect_residue(df, ["doc"], "description").collect()}


@pytest.mark.parametrize("k", range(len(CASES)))
def test_case(found, k):
    assert found.get(k), CASES[k]


@pytest.mark.parametrize("k", range(len(HONEST) + len(NOTHING)))
def test_honest(found, k):
    assert len(CASES) + k not in found, (HONEST + NOTHING)[k]


def test_unmarked_filler_is_found_by_its_words(spark):
    filler = "quemas semper noctis torna vastum pellet"
    data = [(1, f"Lorem ipsum {filler}."), (2, filler.capitalize() + "."), (3, "The mill shows a semper of five red boxes."), (4, "A plain picture of a mill.")]
    df = spark.createDataFrame(data, "k int, d string")
    assert {r.k for r in residue.detect_residue(df, ["k"], "d").collect()} == {1, 2}


def test_empty_and_long(spark):
    df = spark.createDataFrame([(1, "word " * 200_000 + "{{ x }}"), (2, "x" * 500_000)], "k int, d string")
    assert {r.k for r in residue.detect_residue(df, ["k"], "d").collect()} == {1}
    none = residue.detect_residue(df.where("false"), ["k"], "d")
    assert none.columns == ["k", "kinds"] and none.count() == 0


def test_nothing_but_a_quoted_placeholder(spark):
    residue_ = ['"{{caption}}"', "`{{caption}}`", "“{{caption}}”", ' "{{caption}}"\n']
    shown = ['A settings page whose label reads "{{caption}}" in grey.', '"The late mill"', "{x | x > 3}", "`x = 3`"]
    df = spark.createDataFrame(list(enumerate(residue_ + shown)), "k int, text string")
    assert {r.k for r in residue.detect_residue(df, ["k"], "text").collect()} == set(range(len(residue_)))
