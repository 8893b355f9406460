"""What a text must have to be taken for a format. re: a regex; a||b: one of them; !a: not a."""

MARKERS = {
    "gcc_text": (r"re:(?m)^((?:[A-Za-z]:)?[^:\s][^:]*):\d+:\d+:\s*(?:fatal )?(?:error|warning|note):", "!.py:"),
    "generic_error": (r"re:(?im)^\s*\[?(?:error|fatal|fail|failed|critical|exception|panic|warning|warn)\]?(?::|\s)",),
    "make_error": ("make: ***||Entering directory||Leaving directory", "make"),
    "cmake_build": ("CMake Error||CMake Warning||-- Configuring incomplete",),
    "bazel_build": ("INFO: Analyzed||INFO: Build completed||bazel build||bazel test",),
    "maven_build": ("[INFO]||[ERROR]", "maven||BUILD FAILURE||BUILD SUCCESS||Tests run:"),
    "gradle_build": ("> Task :||BUILD SUCCESSFUL||BUILD FAILED||Execution failed for task||* What went wrong:",),
    "msbuild": ("Microsoft (R) Build Engine||MSBuild||Build FAILED.||Build succeeded.||): error CS||): warning CS||[xUnit.net",),
    "unity_editor": ("Unity Editor version:||unity-editor||[Licensing::||DisplayProgressbar:",),
    "cargo_build": (r"re:(?m)^error\[E\d+\]|^test \S+ \.\.\. |panicked at|^error: could not compile|^Diff in ",),
    "node_build": ("npm ERR!||yarn install||.test.js||ERROR in||Test suite failed to run||Could not resolve dependency:||Module not found:",),
    "python_build": ("ERROR: Failed building wheel for||failed with exit status||setuptools||AssertionError:||ModuleNotFoundError:||ImportError:",),
    "docker_build": (r"re:(?m)^Step \d+/\d+ : |^#\d+ (?:\[|DONE|CACHED|ERROR)",),
    "pylint_text": (r"re:(?m)^\*+ Module |Your code has been rated|^[^:\s]+\.py:\d+:\d+: [CRWEF]\d{4}:",),
    "mypy_text": (r"re:(?m)^[^:\s]+\.pyi?:\d+:(?:\d+:)? (?:error|warning|note): |^Success: no issues found",),
    "flake8_text": (r"re:(?m)^[^:\s]+:\d+:\d+: [A-Z]{1,3}\d+ ",),
    "black_text": ("would reformat||All done! ✨ 🍰 ✨||files would be reformatted",),
    "yapf_text": ("yapf||Reformatted ||(original)", "!PLAY ["),
    "clang_tidy_text": (r"re:(?m)^[^:\s]+:\d+:\d+: (?:error|warning|note): .* \[[a-z][a-z0-9.]*-[a-zA-Z0-9.,-]+\]$",),
    "autopep8_text": ("autopep8 --||--- original/||+++ fixed/",),
    "isort_text": ("Imports are incorrectly sorted||isort||:before||Fixing ", ".py"),
    "bandit_text": (">> Issue:||Code scanned:||Test ID:",),
    "ruff_text": (r"re:(?m)^[A-Z]+\d+ (?:\[\*\] )?|^Found \d+ errors?", "   --> ||fixable with"),
    "eslint_text": (r"re:(?m)^\s+\d+:\d+\s+(?:error|warning)\s+",),
    "rubocop_text": (r"re:\S+\.rb:\d+:\d+:\s*[CWEFR]:\s*|Inspecting \d+ files?",),
    "shellcheck_text": (r"re:In \S+ line \d+:|SC\d{4}",),
    "hadolint_text": (r"re:DL\d{4}|Dockerfile:\d+\s+\w+\s+(?:error|warning|info|style):",),
    "pytest_text": (r"re:(?m)::\S+ (?:PASSED|FAILED|SKIPPED|ERROR)|^(?:FAILED|ERROR) \S+\.py::|^=+ .* in [\d.]+s",),
    "pytest_cov_text": ("Stmts", "Cover", "::||passed in||test session starts"),
    "coverage_text": ("Name", "Stmts", "Miss", "Cover"),
    "junit_text": (r"re:(?m)^Tests run: \d+|<<< (?:FAILURE|ERROR)!|[├└]─+ .* [✔✘]",),
    "gtest_text": (r"re:(?m)^\[(?: RUN |==========|  PASSED  |  FAILED  |       OK )",),
    "gotest_text": (r"re:(?m)^\s*--- (?:PASS|FAIL|SKIP): |^(?:ok|FAIL)\s+\S+\s+[\d.]+s",),
    "rspec_text": (r"re:(?m)^rspec \./|^\d+ examples?, \d+ failures?",),
    "mocha_chai_text": (r"re:(?m)^\s+\d+ (?:passing|failing|pending)",),
    "nunit_xunit_text": ("NUnit||xUnit||Test Count:||[xUnit.net",),
    "duckdb_test": ("test cases:||unittest is a Catch",),
    "playwright_text": (r"re:\[(?:chromium|firefox|webkit)\] › ",),
    "strace": (r"re:(?m)\w+\([^)]*\)\s*=\s*[-\d]|---\s+SIG\w+\s+\{|execve\(",),
    "valgrind": ("==", "Memcheck||HEAP SUMMARY||LEAK SUMMARY||Invalid read||Invalid write"),
    "gdb_lldb": ("(gdb)||(lldb)||Program received signal||* Thread||thread #",),
    "github_actions_text": ("::error||::warning||::group::||##[group]||##[error]||##[warning]",),
    "gitlab_ci_text": ("Running with gitlab-runner||section_start:||Job succeeded||Job failed",),
    "jenkins_text": ("Started by||Building in workspace||Finished: SUCCESS||Finished: FAILURE||Finished: UNSTABLE||[Pipeline]",),
    "ansible_text": ("PLAY [||TASK [||PLAY RECAP",),
    "lcov": ("SF:", "end_of_record||DA:||LF:"),
    "logfmt": (r"re:(?m)^[^\n]*\b\w+=\S+[^\n]*\b\w+=\S+[^\n]*\b(?:level|lvl|msg|severity)=",),
    "syslog": (r"re:(?m)^[A-Z][a-z]{2}\s+\d{1,2}\s+\d{2}:\d{2}:\d{2}\s+\S+ [^\s:\[]+(?:\[\d+\])?:|^<\d+>\d+\s+", "!kernel: IN=", "!SRC="),
    "apache_access": (r"re:(?m)^\S+\s+\S+\s+\S+\s+\[[^\]]+\]\s+\"",),
    "nginx_access": (r"re:(?m)^\S+\s+\S+\s+\S+\s+\[[^\]]+\]\s+\"[^\"]*\" \d{3} \S+ \"[^\"]*\" \"[^\"]*\"",),
    "apache_error": (r"re:(?m)^\[(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) \w{3} \d{1,2} \d{2}:\d{2}:\d{2}(?:\.\d+)? \d{4}\] \[",),
    "python_logging": (r"re:(?m)^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}[,.]\d+\s+-\s+\S+\s+-\s+(?:DEBUG|INFO|WARNING|WARN|ERROR|CRITICAL|FATAL)\s+-|^(?:DEBUG|INFO|WARNING|ERROR|CRITICAL):\S+?:",),
    "log4j": (r"re:(?m)^\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}[,.]\d+\s+(?:TRACE|DEBUG|INFO|WARN|ERROR|FATAL)\s+\[|^\d{2}:\d{2}:\d{2}[,.]\d+\s+\[",),
    "logrus": (r"re:(?m)^time=.*level=.*msg=|^(?:PANIC|FATAL|ERROR|WARN|INFO|DEBUG|TRACE|ERRO|DEBU|FATA)\[\d+\]",),
    "winston": (r're:"level"\s*:\s*"(?:error|warn|info|http|verbose|debug|silly)".*"message"|(?m)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d+Z\s+\[\w+\] \w+:', '!"severity"'),
    "serilog": (r're:(?m)"@t"\s*:|"@mt"\s*:|^\[\d{2}:\d{2}:\d{2} (?:VRB|DBG|INF|WRN|ERR|FTL)\]|^\[.*\]\s+\[(?:VRB|DBG|INF|WRN|ERR|FTL)\]',),
    "windows_event": ("Log Name:", "Event ID:", "Source:"),
    "iptables": ("kernel:||kernel[", "SRC=", "IN="),
    "hdfs": (r"re:(?m)^\d{6} \d{6} \d+ (?:INFO|WARN|ERROR|DEBUG|FATAL) ",),
    "spark": (r"re:(?m)^\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2} (?:INFO|WARN|ERROR|DEBUG|FATAL) ",),
}
