"""Prices of runs of letters as words: a fixed letter-pair model, and longer ordinary words that it makes too dear.

Counted over distinct words (weights 1 + ln of their counts) of English technical prose: the docstrings and help topics
of Python and the usual licence texts.  Nothing is learnt from the corpus that is scanned.
"""

from __future__ import annotations

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: One row per letter before (first the word's start, then a to z), one place per letter a to z: tenths of -log10 of
#: the share in base 36, rounded up.  So a row's shares sum to at most 1, and no more than 10^x strings cost up to x.
_ROWS = """cfacdeihdpmfehfcocadhkgsps yecftngvevk9fbyfy9c8jkmojs akhkaprrbgr7kobirddjaoprhr augo9wwbewddqr7tqfk9ewwwmw
dmng5qks7ouhqmdougdjenooku eoc9ihjqnwsefaohl89erimfmv cppoaarr7rreoo8ordkfcprrgr cprr7ofbarrfjcforacjcprrro
8rrr6nrr9rrhkl9rrfldjrprkr ghcfehfytyqee6aiuhdbugymyi fifi8iiiiiiiiibiiifi7iiiii elnj5nen8nnendkinlanhlenln
anmg7mqt8wtatramwrgfgoswat 8euo6quuauqlfnb9urgnfrrunu cqcbbi8peuklojfouqa8iiuxmu kieenkitkxjdc6hdx9ffcgfnrt
9rpl8quieuoaqqadu8hdftsuju kkikkkkkkkkhkkkkkikk2kkkkk aphg6mjtavkkfiblxgcdilmxhx gwes7mqdaukhnoedrrb8buowiw
bpkp7oyc7yuinsdnybcggsnvgv edeiekhueuubd8jeuaaaruuuuu 8qqq3qqq8qqqqqeqoqoqqqqqqq 8pnkampa8ppgpdappbdpppjmpp
dlan9jniannjknn8nli8nnnfkn jgghcnknannfdbcang9bnkgnnn 9kkk4kkkbkkkhkdkkkkkkkkkhk""".split()

PAIR = {a + b: int(c, 36) / 10 for a, row in zip("^" + _LETTERS, _ROWS, strict=True) for b, c in zip(_LETTERS, row, strict=True)}

#: Ordinary words of seven letters and more.
KNOWN = frozenset("""absolute abstract acceptance accepted accepting accepts accessed accesses accessible accessing accompany according
acquired actually addition additional additionally address addressed addresses adjacent adjusted administration
administrator affected affects aggregate agreement algorithm algorithms alignment allocated alphabet already alternate
alternative although ambiguous animation annotation annotations anonymous anything anywhere appearance appeared appears
appended appending applicable application applications applied applies approach appropriate appropriately approximation
arbitrary archives argument arguments arithmetic arrangement assigned assignment assignments assigns associated assuming
asynchronous asyncio attached attachment attempt attempted attempts attribute attributes auditing augmented
authentication authors automatic automatically available awaitables awakened background backslash backslashes backward
backwards barrier because beginning behaves behavior behaviour between bitwise blocking boolean boundaries boundary
bracket brackets breaking breakpoint breakpoints browser browsers buffered buffering buffers builtin builtins buttons
bytecode calculate calculated callables callback callbacks cancellation cancelled candidate canonical capture captured
category certificate certificates channel character characters children circular circumstances circumvention classmethod
cleanup clearly clipboard coefficient collected collection collections colorizing columns combination combined combining
commands comments commercial commonly communication comparing comparison comparisons compatibility compatible
compilation compiled compiler compiles completed completely completion completions compliance compliant complicated
component components comprehension compressed compression concatenation concerns concurrent conditional conditions
confidential configuration configured conjunction connected connection connections consecutive consequence considered
consistent consisting conspicuously constants constraints construct constructed construction constructor constructs
construed contained container containers containing continuation continues contributor controlled controlling controls
convenience convenient convention conversion conversions converted converting conveyed conveying cookies coordinate
coordinates copyleft copyright copyrighted coroutine coroutines correctly correlation correspond corresponding
corresponds countries credential credentials cumulative currently customarily customization customize customized damages
database dataclass datagram datetime debugged debugger debugging decision declaration declarations decorator decorators
default defaulting defaults definition definitions delegate delimited delimiter delimiters denominator dependent
depending deprecated derivative derivatives descendants describe described describes describing description descriptions
descriptor descriptors designated designed destination destroyed detailed details determine determined determines
development deviation dictionaries dictionary difference differences different differently digitpart direction directly
directories directory dirnames dirpath disabled discarded disclaimer discussed dispatch display displayed displaying
displays distance distinguishing distribute distributed distributing distribution distributions division docstring
docstrings document documentation documented documents drawing drawings duplicate duplicates dynamic dynamically earlier
effective effectively efficient electronic elements elsewhere embedded emitted enclosed enclosing encountered enforce
entirely environment equality equivalent especially essential established evaluate evaluated evaluates evaluating
evaluation eventually everyone everything exactly example examples exception exceptional exceptions excluded excluding
exclusion exclusive exclusively executable executables execute executed executes executing execution executor exercise
exhausted existing expanded expected explanation explicit explicitly exponent expressed expression expressions expressly
extension extensions external extracted facilities facility factory failure fallback features filename filenames fileobj
filesystem fillcolor finalizer finished floating flushing followed following follows forceload foreground formatted
formatter formatters formatting forward fraction fractional fractions fragment framework freedom frequency frozenset
fullname funcname functionality functions functools garbage generally generated generator generators geometry globals
governed government grammar graphics greatest grouping guarantee guaranteed guarantees handled handlers handles handling
handshake happened happens hardware hashable hashlib hexadecimal hierarchy highlight highlightbackground highlightcolor
highlightthickness history homecls horizontal hostname however identical identification identified identifier
identifiers identify identifying identity idlelib ignoring illegal imaginary immediate immediately immutable implement
implementation implementations implemented implementing implements implicit implicitly important imported importing
importlib imports include included includes including incompatible incomplete incorporated incorrectly incremental
indentation independent indicated indicates indicating indicator indirect indirectly individual infinite infinity
information infringed infringement inheritance inherited inherits initialization initialized initializing initially
insertion installation installed instance instances instantiate instantiated instantiating instantiation instruction
instruments integers integral interaction interactive interactively intercept interchange interesting interface
interfaces intermediate internal internally international interpolation interpretation interpreted interpreter interval
intervals introduce introduced introduces introspection invariant invocation invoked invokes invoking involved
irrefutable iteration justify keeping keybinding keybindings keyword keywords knowledge language legally legibly
liability libraries library licensed licensee licenses licensors likewise limitation limitations literally literals
litigation loading localhost location loggers logging logical looking lowercase mailbox management managers manuals
mappings markobject matching material materials maximum maxlinelen maxsplit meaningful measures mechanism membership
mentioned messages metaclass metaclasses metadata methods milliseconds minimum modification modifications modified
modifiers modifies modifying modname modules movement multiline multipart multiple multiplication namespace namespaces
narrowing natural necessarily necessary negative neither netmask network networks newline newlines noncommercially
nonlocal nonnegative nonzero normalization normally notation notebook nothing notices notified numbered numbering
numbers numeric numerical numerically objclass objects obligations obtained occurred occurrence occurrences occurring
offering official omitted opcodes operands operating operation operations operator operators opposite optimization
optimized optional optionally ordinary organization orientation original originally otherwise outline overhead overlap
overlapping overload overridden override overrides overriding overview overwritten ownership package packages
panedwindow paragraph parallel parameter parameters parentheses parenthesis partially particular passage password
pathname patterns payload pencolor perform performance performed performing performs perhaps permanently permission
permissions permissive permitted persistent physical pickled pickling placeholder platform platforms polygon population
position positional positions positive possible possibly potential powerful precedence precisely precision preferred
prefixed prefixes presentation preserved preserves preserving previous previously primarily principal printable
printables priority probability probably problems proceeds processed processes processing produce produced produces
producing product products program programmer programming programs prominent propagate propagated propagation properly
properties property proposal proposed proprietary protecting protection protocol protocols provided provides providing
provision provisionally publicly publish published publisher purpose purposes pyshell qualified quotation quoting
readable readline realname reasonable reasonably receipt receive received receives receiving recipient recipients
recognize recognized recommend recommended rectangle rectangular recursion recursive recursively redistribute reference
referenced references referred referring reflected reflection regardless register registered registering registry
regression reinstated relationship released releases relevant relicensing remainder remaining removing repeated
repeatedly repetition replaced replacement replaces replacing reported represent representable representation
representations representative represented representing represents reproduce reproducing requested requests required
requirement requirements requires requiring resizemode resolution resolve resolved resolving resource resources
respectively respects responses responsibilities responsibility responsible restricted restriction restrictions
restrictive resulting retained retrieve retrieved returncode returned returning returns rightmost rollover roughly
royalty running satisfy scheduled scientific searched searching securities security seeking segments selection selector
semantically semantics semaphore sensitive separated separately separating separator separators sequence sequences
serialized serverthread settings severity shearfactor shorthand shutdown sidebar signaling signals signature significand
significant silently simultaneously singleton skipped slightly smallest sockets software someone something sometimes
sources special specialized specially specific specifically specification specified specifier specifies specify
specifying spinbox splitting standard startline statement statements statespec statistics stopping streams stretchfactor
strictly stripped structural structure structures subclass subclassed subclasses subclassing subdirectories sublicense
submodule submodules subnormal subparts subpattern subpatterns subprocess subscription subsequent subsequently
substituted substitutions substring subtype succeed succeeds success successful successfully sufficient suffixes
suitable supplied support supported supporting supports suppress surrogateescaped surrounded surrounding suspended
symbolic symbols symlink symlinks syntactic syntactically systems takefocus targetpath targets telephone temporarily
temporary terminal terminate terminated terminates termination textual textvariable themselves therefore thereof
thisclass thousands threading threads through timedelta timeout timestamp timezone tkinter together tooltip toplevel
topmost towards traceback trailing transaction transfer transferring transformation transformed translate translated
translation translations transmission transparent transport triggered truncated turtles turtleshape typical typically
unavailable unbound unchanged uncombined uncompressed undefined underline underlying underscore underscores understands
understood unexpected universal university unknown unlimited unlocked unmodified unpacking unpickling unquoted unsigned
unspecified unsupported updated updates updating uppercase username usually utility validate variable variables variance
variant verbatim vertical violation virtual visible visitor warnings warranties warranty weekday whenever whitespace
widgets wildcard windows wrapped wrapper wrapping writable written yielded yielding yourself""".split())
