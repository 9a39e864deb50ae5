"""What the residue models are trained on: phrases made by rule from parts, standard lists and markers.

Phrases are combinations of general words of five languages, some of which are titles of tables too, and the standard
library gives the messages of servers, systems and programs. Natural titles come from the table itself; the plain word
combinations here only stand for them where a table is very small.
"""

from __future__ import annotations

import builtins
import itertools
import os
import re
from http import HTTPStatus

_CHOICE = re.compile(r"\(([^()]*)\)")


def spelled(pattern: str) -> list[str]:
    """Every phrase of a pattern in which '(a/b/)' stands for a, b or nothing."""
    parts = _CHOICE.split(pattern)
    choices = [p.split("/") if i % 2 else [p] for i, p in enumerate(parts)]
    return list(dict.fromkeys(" ".join("".join(c).split()) for c in itertools.product(*choices)))


def phrases(block: str) -> list[str]:
    return list(dict.fromkeys(x for line in block.strip().splitlines() for x in spelled(line.strip()) if x))


# ---- fixed values: patterns of phrases ----
FILLER = """
(texto/titulo/nome/descricao/conteudo/programa/sinopse/evento/registro) (de exemplo/de teste/exemplo/teste/padrao/provisorio/temporario/aqui/generico)
(texto/titulo/nombre/descripcion/contenido/programa/sinopsis) (de ejemplo/de prueba/de relleno/ejemplo/por defecto/provisional/aqui)
(insira/digite/escreva/coloque/informe/preencha) (o/a/seu/um/) (titulo/texto/nome/descricao/conteudo) (aqui/do programa/do programa aqui/)
(inserte/escriba/introduzca/ingrese/ponga) (el/su/un/) (titulo/texto/nombre/contenido) (aqui/del programa/del programa aqui/)
(your/insert/enter/type/add/put/edit) (the/a/your/) (title/text/name/description/content) (here/)
(sample/dummy/placeholder/default/test/example/filler) (title/text/name/content/description/entry/data/programme)
(titre/texte/nom/contenu) (d exemple/de test/par defaut/provisoire/ici)
(titolo/testo/nome/contenuto) (di esempio/di prova/predefinito/provvisorio/qui)
(title/text/name/content) (goes here/here/to follow/placeholder)
(titulo/programa/nome/evento/exemplo/teste/item/sample/test/title) (1/01/123/xyz/abc/x)
favor (ignorar/desconsiderar)
(please/) (ignore/disregard) (this/this text/this entry)
(titulo/programa/nome/horario/evento/descricao/sinopse) (nao/ainda nao) (informado/fornecido/cadastrado/definido/disponivel/enviado/encontrado/divulgado/confirmado)
(informacao/programacao/grade/descricao/sinopse) (nao/ainda nao) (informada/fornecida/cadastrada/definida/disponivel/enviada/encontrada/divulgada/confirmada)
(titulo/programa/horario/evento/atracao) (a definir/a confirmar/a anunciar/a ser definido/a ser confirmado/a ser anunciado/por definir/por confirmar/em breve/indisponivel/desconhecido/ausente)
(informacao/informacoes/programacao/grade/dados/descricao/sinopse) (indisponivel/indisponiveis/ausente/ausentes/pendente/a confirmar/a definir)
(a definir/a confirmar/a ser definido/a ser confirmado/a anunciar/por definir/por confirmar/por anunciar)
(sem/canal sem/programa sem/evento sem) (titulo/nome/informacao/informacoes/dados/programacao/descricao/sinopse/registro/grade) (disponivel/cadastrado/cadastrada/informado/informada/definido/)
(nao ha/nenhum/nenhuma) (titulo/nome/informacao/programacao/descricao/dados/grade) (disponivel/cadastrado/cadastrada/informado/informada/)
nada (consta/informado/cadastrado/a exibir)
(nao/no) (informado/consta/definido/disponivel/cadastrado/preenchido/aplicavel)
(titulo/programa/nombre/horario/evento) (no disponible/no informado/no definido/sin definir/por definir/por confirmar/por anunciar/desconocido)
(informacion/programacion/descripcion/sinopsis/guia) (no disponible/no informada/no suministrada/sin definir/por confirmar)
(sin/programa sin/canal sin) (titulo/nombre/informacion/datos/programacion/descripcion/sinopsis) (disponible/definido/)
(no/no hay/ningun) (titulo/nombre/informacion/programacion/descripcion/datos) (disponible/disponibles/)
(no/missing/unknown/empty/blank) (title/name/data/information/info/description/schedule/listing/programme/program/programme information/program information/synopsis/details) (available/provided/given/supplied/found/set/)
(title/name/data/information/description/schedule/listing/programme/program/programme information/synopsis) (not/not yet/currently not/is not) (available/provided/given/supplied/found/set/known/announced/confirmed)
(title/name/schedule/listing/programme/details/information) (unavailable/missing/unknown/pending/tba/tbc/tbd/to follow)
(to be/to be/will be) (announced/confirmed/determined/defined/decided/advised)
(titre/programme/nom/horaire/resume) (non/pas) (disponible/fourni/renseigne/communique/defini)
(sans/pas de/aucun/aucune) (titre/nom/donnees/information/programme/description) (disponible/)
(titolo/programma/nome/orario/trama) (non/non ancora) (disponibile/fornito/indicato/definito/comunicato)
(senza/nessun/nessuna) (titolo/nome/dati/informazione/programma/descrizione) (disponibile/)
(a/da/à) (definire/confermare/annoncer/confirmer/determiner)
(untitled/unnamed/unknown/undefined/unspecified) (programme/program/show/event/item/)
(em branco/vazio/vacio/blank/empty/vide/vuoto) (titulo/campo/field/)
"""
#: The usual filler paragraph, set phrases and what languages and sheets print for a missing value.
LOREM = """lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo
 consequat. duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum"""
NOTHING = (
    "null", "(null)", "none", "nil", "nan", "undefined", "void", "n/a", "n.a.", "n/d", "s/d", "tba", "tbc", "tbd", "#n/a", "#ref!", "#value!", "#name?", "#null!", "#num!", "#div/0!", "array", "array()", "object", "[object object]", "[object array]",
    "[]", "{}", "nonetype", "<class 'nonetype'>", "dbnull", "false", "system.object", "system.string[]", "system.dbnull", "system.collections.generic.list", "java.lang.object", "java.lang.string", "java.util.arraylist", "java.util.hashmap",
    "function () {}", "function anonymous() {}", "function () { [native code] }", "[native code]", "[object function]", "<none>", "<null>", "<empty>", "lipsum", "lorem", "foo", "bar", "foo bar", "foo bar baz", "foobar", "hello world",
)
#: Rows of keys, and words that are typed as a test.
KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghij")
TESTS = ("test", "teste", "prueba", "prova", "testing", "testando", "probando", "abc", "asdf", "qwerty", "xyz", "blah", "bla", "foo", "aaa", "xxx")

ERRORS = """
(falha/erro/problema/erro interno) (ao/na tentativa de) (carregar/abrir/obter/ler/buscar/processar/acessar/exibir/conectar com/baixar) (a grade/a pagina/a programacao/a lista/a imagem/os dados/o guia/o conteudo/o servidor/o arquivo/o recurso)
(nao foi possivel/impossivel) (carregar/abrir/obter/ler/buscar/processar/acessar/exibir/conectar) (a grade/a pagina/a programacao/a lista/os dados/o guia/o conteudo/o servidor/o arquivo/)
(erro/error/fallo) (al) (cargar/abrir/obtener/leer/procesar/mostrar/conectar con) (la pagina/la guia/la programacion/los datos/el contenido/el servidor/el archivo)
(no se pudo/no se ha podido/imposible) (cargar/abrir/obtener/leer/mostrar) (la pagina/la guia/la programacion/los datos/el contenido/el archivo)
(could not/cannot/can not/unable to/failed to/error while trying to) (load/fetch/retrieve/parse/open/read/display/connect to/get) (the/) (data/schedule/schedule data/page/guide/feed/server/content/file/resource/listing)
(error/failure/problem) (loading/fetching/retrieving/parsing/opening/reading/connecting to) (the/) (data/schedule/page/guide/feed/server/content/file)
(servidor/servico/site/sistema/recurso/conteudo/sinal) (temporariamente/momentaneamente/) (indisponivel/fora do ar/sobrecarregado/em manutencao/nao encontrado/inacessivel)
(a/esta/) (pagina/url) (solicitada/que voce procura/requisitada/) (nao foi encontrada/nao encontrada/nao existe/nao esta disponivel/foi removida)
(o/este/) (arquivo/recurso/conteudo/endereco/documento) (solicitado/) (nao foi encontrado/nao encontrado/nao existe/foi removido)
(la/esta/) (pagina/url) (solicitada/que busca/) (no fue encontrada/no encontrada/no existe/no esta disponible)
(servidor/servicio/sitio/sistema) (temporalmente/) (no disponible/fuera de servicio/en mantenimiento/no disponible temporalmente)
(the/this/) (page/file/resource/url/document) (you requested/you are looking for/requested/) (was not found/could not be found/cannot be found/not found/does not exist/is not available)
(service/server/site/system/resource) (is/) (temporarily/currently/) (unavailable/down/offline/overloaded/under maintenance/not responding)
(sua/a/esta/) sessao (expirou/expirada/foi encerrada/e invalida) (faca login novamente/entre novamente/por favor faca login/)
(su/la/) sesion (ha expirado/expirada/caduco) (inicie sesion de nuevo/vuelva a iniciar sesion/)
(your/the/) session (has expired/expired/timed out/is invalid) (please log in again/please sign in again/log in to continue/)
(token/certificado/chave/licenca/credencial/assinatura/usuario) (invalido/invalida/expirado/expirada/ausente/revogado/invalido ou expirado)
(invalid/expired/missing/unknown/bad) (token/certificate/key/api key/license/credentials/signature/request/response/parameter/argument/format)
(token/certificate/key/license/credentials) (is/has/) (invalid/expired/missing/revoked)
(acesso/permissao) (negado/negada/proibido/nao autorizado/nao permitido/bloqueado) (voce nao tem permissao/token invalido/)
(acceso/permiso) (denegado/prohibido/no autorizado)
(access/permission) (denied/forbidden/blocked/not allowed/is denied) (you do not have permission/invalid token/)
(tempo/tempo limite) (de espera/de conexao/de resposta/da requisicao/) (esgotado/excedido)
(limite/cota/numero maximo) (de requisicoes/de acessos/de uso/de consultas) (excedido/excedida/atingido/esgotado)
(tiempo/limite) (de espera/de conexion/de solicitudes) (agotado/excedido/superado)
(request/connection/gateway/operation/query/response) (timed out/time-out/timeout/refused/failed/aborted/reset/closed/limit exceeded/was reset)
(rate limit/quota/limit/too many requests/maximum number of connections) (exceeded/reached/)
(ops/opa/ai/que pena/desculpe)! (algo deu errado/algo saiu errado/ocorreu um erro/houve um problema/encontramos um problema)
(algo deu errado/algo saiu errado/ocorreu um erro/houve um erro/ocorreu um erro inesperado/erro inesperado/erro desconhecido/erro interno/erro interno do servidor/erro no servidor/erro de conexao/erro de servidor) (tente novamente/tente mais tarde/tente novamente mais tarde/por favor tente de novo/)
(algo salio mal/algo ha ido mal/ocurrio un error/se produjo un error/error inesperado/error interno/error interno del servidor/error de conexion) (intente de nuevo/intentelo mas tarde/)
(oops/sorry/whoops)! (something went wrong/an error occurred/there was a problem/we could not find that page)
(something went wrong/an error occurred/an error has occurred/an unexpected error occurred/unexpected error/unknown error/internal error/internal server error/server error/application error/database error/connection error/network error/fatal error/critical error) (please try again/please try again later/try again later/)
(une erreur est survenue/erreur interne/erreur du serveur/page non trouvee/page introuvable/acces refuse/session expiree/service indisponible) (veuillez reessayer/)
(si e verificato un errore/errore interno/errore del server/pagina non trovata/accesso negato/sessione scaduta/servizio non disponibile) (riprova/riprova piu tardi/)
(fatal error/parse error/warning/notice/deprecated): (uncaught exception/uncaught error/unexpected token/undefined index/undefined variable/undefined offset/undefined property/call to undefined function/headers already sent/division by zero/out of memory/stack overflow/maximum execution time exceeded/syntax error)
(undefined/unknown/invalid) (index/variable/offset/property/function/method/key/column/symbol/reference)
cannot (read/set) (property/properties) of (undefined/null) (reading/)
(unexpected token/unexpected end of input/unexpected end of file/unexpected character/unexpected identifier) (in json/at position/in line/)
(syntax error/parse error/error) (in/near/at/on) (line/sql/query/json/xml/input/position)
(sqlstate/ora-/mysql/sqlite/psql/odbc) (error/syntax error/connection failed/server has gone away/no such table/deadlock detected/duplicate entry)
sqlstate[(42000/08006/23000/42s02/hy000)] (syntax error/general error/access violation/connection failure/base table or view not found)
(traceback/stack trace/call stack/backtrace) (most recent call last/)
(core dumped/segmentation fault/stack overflow/out of memory/memory limit exceeded/null pointer/assertion failed/panic/kernel panic/unhandled exception/unhandled promise rejection/broken pipe/bad gateway)
(ssl/tls/dns/http/tcp/proxy/cors/api/xml/json/ftp) (error/handshake failed/certificate error/connection error/lookup failed/parse error/request failed)
"""
#: First words of exceptions' names, and packages and calls they come with.
EXCEPTIONS = ("null pointer", "class cast", "illegal argument", "illegal state", "index out of bounds", "array index out of bounds", "file not found", "number format", "no such element", "unsupported operation", "runtime", "io", "socket", "socket timeout", "sql", "timeout", "parse", "format", "null reference", "argument null", "key not found", "web", "json", "xml", "unknown host", "out of memory", "stack overflow")
PACKAGES = ("", "java.lang.", "java.io.", "java.net.", "system.", "org.json.")
PLACES = ("", " at app.run", " at main", " at render", " at line 1", ": null")

SCRIPTS = """
(please/you need to/you must/you have to/to continue/) (enable/activate/turn on/allow/switch on) (javascript/scripts/cookies/javascript and cookies/cookies and javascript) (to view this page/to view this site/to continue/to run this app/to use this site/in your browser/in order to continue/)
(javascript/scripts/cookies/scripting) (is/are/must be/has to be/needs to be/seems to be/appears to be) (disabled/turned off/required/enabled/not enabled/blocked) (in your browser/to view this page/to continue/on this site/)
(this/our) (site/page/website/application/app/content) (requires/needs/uses/works best with) (javascript/cookies/scripts/a modern browser/javascript to be enabled/javascript and cookies)
(noscript/no script): (turn on scripts/enable javascript/please enable scripts/javascript required)
(your/this) browser (does not support/is not supporting/doesn't support/is blocking) (javascript/scripts/cookies/this feature/this content/html5 video/this video/frames)
your browser (is out of date/is not supported/is outdated) (please update/please upgrade your browser/)
(checking/verifying/please wait while we check/please wait while we verify/we are checking) (your browser/that you are human/if you are human/your connection/if the site connection is secure) (before accessing/before you continue/before accessing this site/please wait/)
(verify/confirm/prove) (you are/that you are) (human/not a robot) (to continue/)
(complete/solve) (the/this) (security check/captcha/challenge) (to continue/to access this page/)
(i am not a robot/ddos protection by/redirecting to the site/one moment please/just a moment)
(ative/habilite/ligue/permita/e necessario ativar/e preciso habilitar/e necessario habilitar/por favor ative/por favor habilite/voce precisa habilitar) (o/os/) (javascript/scripts/cookies/javascript e os cookies) (no seu navegador/no navegador/para continuar/para ver esta pagina/para acessar o site/para visualizar o conteudo/)
(este/esse/nosso) (site/aplicativo/conteudo/recurso) (requer/precisa de/exige/necessita de/usa) (javascript/scripts/cookies/um navegador moderno/javascript habilitado)
(esta/essa/nossa) pagina (requer/precisa de/exige/necessita de) (javascript/scripts/cookies/javascript habilitado)
(javascript/scripts/cookies) (esta/estao) (desativado/desativados/desabilitado/desabilitados/bloqueado/bloqueados) (no seu navegador/neste site/)
(o seu/seu/este) navegador (nao suporta/nao aceita/nao permite/nao e compativel com/esta bloqueando) (javascript/scripts/cookies/este recurso/este conteudo/este video/esta pagina)
(o seu/seu) navegador (esta desatualizado/nao e compativel/esta bloqueado) (atualize/atualize seu navegador/)
(verificando/estamos verificando/aguarde enquanto verificamos) (o seu navegador/seu navegador/se voce e humano/que voce e humano/sua conexao/a seguranca da conexao) (antes de acessar/antes de continuar/aguarde/)
(confirme que voce e/prove que voce e/verifique se voce e) (humano/uma pessoa)
(nao sou um robo/resolva o captcha/conclua a verificacao de seguranca)
(active/habilite/permita/debe activar/necesita habilitar/por favor active) (el/los/) (javascript/scripts/cookies) (en su navegador/en el navegador/para continuar/para ver esta pagina/)
(este/nuestro) (sitio/contenido) (requiere/necesita/usa) (javascript/cookies/scripts)
(su/este) navegador (no admite/no soporta/no permite/no es compatible con/bloquea) (javascript/scripts/cookies/esta funcion/este contenido)
(comprobando/verificando/estamos comprobando) (su navegador/que usted es humano/si usted es humano) (antes de acceder/antes de continuar/)
(veuillez activer/activez/vous devez activer/merci d activer) (javascript/les cookies/les scripts) (dans votre navigateur/pour continuer/pour afficher cette page/)
votre navigateur (ne supporte pas/ne prend pas en charge/bloque) (javascript/les cookies/cette fonction/ce contenu)
(ce site/cette page) (necessite/requiert/utilise) (javascript/les cookies)
(verification/nous verifions) (de votre navigateur/que vous etes humain/votre navigateur) (avant de continuer/)
(attiva/abilita/e necessario abilitare/devi abilitare/per favore attiva) (javascript/i cookie/gli script) (nel tuo browser/per continuare/per vedere questa pagina/)
(il tuo/questo) browser non (supporta/permette/accetta) (javascript/i cookie/questa funzione/questo contenuto)
(questo sito/questa pagina) (richiede/usa) (javascript/i cookie)
(verifica/stiamo verificando) (del browser/il tuo browser/che tu sia umano) (prima di continuare/)
"""
#: How titles are usually built.
NATURAL = """
(o/a/os/as/um/uma/) (casa/cidade/noite/amor/vida/mundo/tempo/caminho/segredo/historia/filha/mulher/homem/menino/rei/guerra/ilha/estrada/rio/mar/jornal/cine/mesa/sessao/programa) (de/do/da/sem/em/na) (fim/norte/vale/serra/campo/ouro/pedra/paz/honra/sorte/nobreza/familia/esperanca/tarde/manha)
(el/la/los/un/una) (casa/ciudad/noche/vida/mundo/tiempo/camino/secreto/historia/mujer/hombre/rey/guerra/isla) (de/del/sin/en) (fin/norte/valle/oro/piedra/paz/honor/suerte/familia/esperanza)
(the/a/an/) (house/city/night/life/world/time/road/secret/story/woman/man/king/war/island/river/news/show) (of/in/without/and) (the north/the valley/gold/stone/peace/honour/luck/family/hope/the morning)
"""
#: Fields and objects that template markers name; * in a marker stands for the name.
FIELDS = "title titulo name nome description descricao text texto date data time hora start stop value valor id label content channel canal show programa episode episodio ep season temporada number num n genre genero category categoria synopsis sinopse var field key x"
OBJECTS = "item prog program programa event evento show channel episode data page row entry"
MARKERS = "{{ * }}|{{*}}|{{*|{*}|${*}|${ * }|$*$|%*%|%(*)s|[*]|[[*]]|<%= * %>|<%=*%>|<?= $* ?>|<?php echo $* ?>|@@*@@|__*__|#*#|{% block * %}|{% * %}|<*>|#{*}|{{{*}}}"


def filler() -> list[str]:
    sentence = [w.strip(" ,.") for w in LOREM.split()]
    runs = [" ".join(sentence[i:i + n]) for n in (2, 4, 8) for i in range(0, len(sentence) - n + 1)]
    keys = [k[i:i + n] for k in KEYS for n in (4, 5, 6, len(k)) for i in range(max(1, len(k) - n + 1))]
    same = [c * n for c in "abcdefghijklmnopqrstuvwxyz0-_?" for n in (4, 6, 9)]
    words = [" ".join([w] * n) for w in (*TESTS, *keys[::3]) for n in (1, 2, 3)] + [f"{w} {n}" for w in TESTS for n in ("1", "123")]
    return list(dict.fromkeys([*phrases(FILLER), *runs, *keys, *same, *words, *NOTHING, *(f"{x} {x}" for x in NOTHING[:9]), "<title></title>", "<titulo></titulo>"]))


def errors() -> list[str]:
    served = [s for s in HTTPStatus if s.value >= 400]
    out = [x for s in served for x in (s.phrase.lower(), f"{s.value} {s.phrase.lower()}", f"http {s.value} {s.phrase.lower()}", f"http {s.value}", f"error {s.value}", f"erro {s.value}", f"error {s.value}: {s.phrase.lower()}", f"erro {s.value}: {s.phrase.lower()}", f"http error {s.value}", f"{s.phrase.lower()} ({s.value})")]
    out += [os.strerror(n).lower() for n in range(1, 134)]
    out += ["traceback (most recent call last)", "traceback (most recent call last):"]
    python = [x for x in vars(builtins) if x.endswith(("Error", "Exception", "Warning"))]
    out += [f"{x.lower()}{p}" for x in python for p in ("", ": 'title'", ": none")]
    out += [f"{g}{e.replace(' ', '')}exception{p}" for e in EXCEPTIONS for g in PACKAGES for p in PLACES]
    return list(dict.fromkeys([*out, *phrases(ERRORS)]))


def scripts() -> list[str]:
    return phrases(SCRIPTS)


def templates() -> list[str]:
    names = [*FIELDS.split(), *(f"{o}{j}{f}" for o in OBJECTS.split() for j in "._" for f in FIELDS.split()[:12]), *(f"{o}[{k}]" for o in OBJECTS.split() for k in ("0", "1", "'title'"))]
    return [m.replace("*", n) for m in MARKERS.split("|") for n in names]


def all_phrases() -> dict[str, list[str]]:
    return {"filler": filler(), "error": errors(), "script": scripts()}
