"""The built-in formats in registration order, which breaks ties of priority."""

#: name, priority, category, description, aliases, groups
FORMATS = (
    ("eslint_json", 100, "tool_output", "ESLint JavaScript/TypeScript linter JSON output", ("eslint",), ("javascript", "lint")),
    ("stylelint_json", 100, "tool_output", "Stylelint CSS linter JSON output", ("stylelint",), ("javascript", "lint")),
    ("rubocop_json", 100, "tool_output", "RuboCop Ruby linter JSON output", ("rubocop",), ("ruby", "lint")),
    ("swiftlint_json", 100, "tool_output", "SwiftLint Swift linter JSON output", ("swiftlint",), ("swift", "lint")),
    ("phpstan_json", 100, "tool_output", "PHPStan PHP static analysis JSON output", ("phpstan",), ("php", "lint")),
    ("shellcheck_json", 100, "tool_output", "ShellCheck shell script linter JSON output", ("shellcheck",), ("shell", "lint")),
    ("clippy_json", 100, "tool_output", "Rust Clippy linter JSON output", ("clippy",), ("rust", "lint")),
    ("markdownlint_json", 100, "tool_output", "Markdownlint markdown linter JSON output", ("markdownlint",), ("lint",)),
    ("yamllint_json", 100, "tool_output", "Yamllint YAML linter JSON output", ("yamllint",), ("lint",)),
    ("spotbugs_json", 100, "tool_output", "SpotBugs Java static analysis JSON output", ("spotbugs",), ("java", "lint", "security")),
    ("ktlint_json", 100, "tool_output", "Ktlint Kotlin linter JSON output", ("ktlint",), ("java", "lint")),
    ("hadolint_json", 100, "tool_output", "Hadolint Dockerfile linter JSON output", ("hadolint",), ("infrastructure", "lint")),
    ("lintr_json", 100, "tool_output", "Lintr R linter JSON output", ("lintr",), ("lint",)),
    ("sqlfluff_json", 100, "tool_output", "SQLFluff SQL linter JSON output", ("sqlfluff",), ("lint",)),
    ("tflint_json", 100, "tool_output", "Terraform TFLint linter JSON output", ("tflint",), ("infrastructure", "lint")),
    ("kube_score_json", 100, "tool_output", "Kube-score Kubernetes manifest linter JSON output", ("kubescore", "kube_score"), ("infrastructure", "lint")),
    ("bandit_json", 100, "tool_output", "Bandit Python security linter JSON output", ("bandit",), ("python", "security", "lint")),
    ("trivy_json", 100, "tool_output", "Trivy container/dependency vulnerability scanner JSON output", ("trivy",), ("infrastructure", "security")),
    ("tfsec_json", 100, "tool_output", "tfsec Terraform security scanner JSON output", ("tfsec",), ("infrastructure", "security")),
    ("gotest_json", 100, "tool_output", "Go test JSON output (go test -json)", ("gotest", "go_test"), ("go", "test")),
    ("cargo_test_json", 100, "tool_output", "Rust cargo test JSON output", ("cargo_test",), ("rust", "test")),
    ("generic_lint", 30, "tool_output", "Generic lint format (file:line:col: level: message)", ("lint",), ("lint",)),
    ("generic_error", 10, "tool_output", "Fallback parser for error:/warning:/[ERROR]/[FAIL] messages without file:line prefix", ("error", "fallback"), ()),
    ("pytest_text", 80, "test_framework", "Python pytest text output", ("pytest",), ("python", "test")),
    ("pytest_json", 100, "test_framework", "Python pytest JSON report output", (), ("python", "test")),
    ("junit_text", 80, "test_framework", "JUnit/Maven test output in text format", ("junit",), ("java", "test")),
    ("gtest_text", 80, "test_framework", "Google Test (gtest) output format", ("gtest", "googletest"), ("c_cpp", "test")),
    ("rspec_text", 80, "test_framework", "Ruby RSpec test output format", ("rspec",), ("ruby", "test")),
    ("mocha_chai_text", 80, "test_framework", "Mocha/Chai JavaScript test output", ("mocha", "chai"), ("javascript", "test")),
    ("nunit_xunit_text", 80, "test_framework", ".NET NUnit/xUnit test output", ("nunit", "xunit"), ("dotnet", "test")),
    ("duckdb_test", 80, "test_framework", "DuckDB unittest output format", (), ("c_cpp", "test")),
    ("pytest_cov_text", 80, "test_framework", "Python pytest-cov text output with coverage", ("pytest_cov", "pytest-cov"), ("python", "test", "coverage")),
    ("playwright_text", 80, "test_framework", "Playwright test runner text output (list/line reporter)", ("playwright",), ("javascript", "test")),
    ("playwright_json", 100, "test_framework", "Playwright JSON reporter output", (), ("javascript", "test")),
    ("gotest_text", 80, "test_framework", "Go test text output (default format)", ("gotest",), ("go", "test")),
    ("junit_xml", 100, "test_framework", "JUnit XML test results format", (), ("java", "test")),
    ("unity_test_xml", 100, "test_framework", "Unity Test Framework XML results (NUnit 3 format)", (), ("unity", "dotnet", "test")),
    ("gcc_text", 80, "build_system", "GCC-style compiler diagnostics (file:line:col: severity: message)", ("gcc", "g++", "clang", "clang++", "cc", "c++", "gfortran", "gnat", "compiler_diagnostic"), ("c_cpp", "fortran", "build")),
    ("make_error", 50, "build_system", "GNU Make build output with errors", ("make",), ("c_cpp", "build")),
    ("cmake_build", 80, "build_system", "CMake build system output", ("cmake",), ("c_cpp", "build")),
    ("bazel_build", 80, "build_system", "Google Bazel build system output", ("bazel",), ("c_cpp", "java", "build")),
    ("maven_build", 80, "build_system", "Apache Maven build output", ("maven", "mvn"), ("java", "build")),
    ("gradle_build", 80, "build_system", "Gradle build system output", ("gradle",), ("java", "build")),
    ("msbuild", 80, "build_system", "Microsoft MSBuild output", (), ("dotnet", "build")),
    ("unity_editor", 100, "build_system", "Unity Editor build and test logs", ("unity", "unity_build"), ("csharp", "gamedev", "build")),
    ("cargo_build", 80, "build_system", "Rust Cargo build output", ("cargo",), ("rust", "build")),
    ("node_build", 80, "build_system", "Node.js/npm build output", ("node", "npm"), ("javascript", "build")),
    ("python_build", 80, "build_system", "Python build/setup.py output", (), ("python", "build")),
    ("docker_build", 80, "build_system", "Docker build output", ("docker",), ("build", "infrastructure")),
    ("pylint_text", 80, "linting_tool", "Python Pylint code quality output", ("pylint",), ("python", "lint")),
    ("mypy_text", 80, "linting_tool", "Python Mypy type checker output", ("mypy",), ("python", "lint")),
    ("flake8_text", 80, "linting_tool", "Python Flake8 style checker output", ("flake8",), ("python", "lint")),
    ("black_text", 50, "linting_tool", "Python Black formatter output", ("black",), ("python", "lint")),
    ("yapf_text", 100, "linting_tool", "Python YAPF formatter output", ("yapf",), ("python", "lint")),
    ("clang_tidy_text", 80, "linting_tool", "LLVM Clang-Tidy C++ linter output", ("clang_tidy", "clang-tidy"), ("c_cpp", "lint")),
    ("autopep8_text", 80, "linting_tool", "Python autopep8 formatter output", ("autopep8",), ("python", "lint")),
    ("isort_text", 80, "linting_tool", "Python isort import sorter output", ("isort",), ("python", "lint")),
    ("bandit_text", 80, "linting_tool", "Python Bandit security linter output", ("bandit",), ("python", "lint", "security")),
    ("ruff_text", 100, "linting_tool", "Python Ruff linter output", ("ruff",), ("python", "lint")),
    ("ruff_json", 100, "linting_tool", "Python Ruff linter JSON output (--output-format=json)", (), ("python", "lint")),
    ("eslint_text", 80, "linting_tool", "ESLint JavaScript/TypeScript linter text output", (), ("javascript", "lint")),
    ("rubocop_text", 80, "linting_tool", "RuboCop Ruby linter text output", (), ("ruby", "lint")),
    ("shellcheck_text", 80, "linting_tool", "ShellCheck shell script linter text output", (), ("shell", "lint")),
    ("hadolint_text", 80, "linting_tool", "Hadolint Dockerfile linter text output", (), ("docker", "lint", "infrastructure")),
    ("strace", 80, "debugging", "strace system call trace output", (), ("c_cpp", "shell", "debug")),
    ("valgrind", 80, "debugging", "Valgrind memory analysis output", (), ("c_cpp", "debug")),
    ("gdb_lldb", 80, "debugging", "GDB/LLDB debugger output", ("gdb", "lldb"), ("c_cpp", "debug")),
    ("coverage_text", 80, "debugging", "Code coverage report output", ("coverage",), ("python", "coverage")),
    ("github_actions_text", 80, "ci_system", "GitHub Actions workflow log output", ("github_actions",), ("ci",)),
    ("gitlab_ci_text", 80, "ci_system", "GitLab CI pipeline log output", ("gitlab_ci", "gitlab"), ("ci",)),
    ("jenkins_text", 80, "ci_system", "Jenkins build log output", ("jenkins",), ("ci",)),
    ("drone_ci_text", 80, "ci_system", "Drone CI build output", ("drone", "drone_ci"), ("ci",)),
    ("terraform_text", 80, "ci_system", "Terraform plan/apply output", ("terraform", "tf"), ("ci", "infrastructure")),
    ("github_cli", 80, "ci_system", "GitHub CLI (gh) command output", ("gh",), ("ci",)),
    ("jsonl", 50, "structured_log", "JSON Lines (JSONL/NDJSON) log format", ("ndjson", "json_lines"), ("logging",)),
    ("logfmt", 50, "structured_log", "Logfmt key=value log format", (), ("logging",)),
    ("syslog", 80, "web_access", "Unix/Linux syslog format", (), ("web", "logging")),
    ("apache_access", 80, "web_access", "Apache HTTP Server access log", ("apache",), ("web",)),
    ("apache_error", 80, "web_access", "Apache HTTP Server error log", ("apache_err",), ("web",)),
    ("nginx_access", 80, "web_access", "Nginx HTTP Server access log", ("nginx",), ("web",)),
    ("aws_cloudtrail", 80, "cloud_log", "AWS CloudTrail audit logs", ("cloudtrail",), ("cloud", "security")),
    ("gcp_cloud_logging", 80, "cloud_log", "Google Cloud Logging (Stackdriver) logs", ("stackdriver", "gcp_logging"), ("cloud",)),
    ("azure_activity", 80, "cloud_log", "Azure Activity/Audit logs", ("azure",), ("cloud",)),
    ("python_logging", 80, "app_logging", "Python standard logging module output", (), ("python", "logging")),
    ("log4j", 80, "app_logging", "Java Log4j/Log4j2 log output", ("log4j2",), ("java", "logging")),
    ("logrus", 80, "app_logging", "Go Logrus structured logging output", (), ("go", "logging")),
    ("winston", 80, "app_logging", "Node.js Winston logger output", (), ("javascript", "logging")),
    ("pino", 80, "app_logging", "Node.js Pino logger output", (), ("javascript", "logging")),
    ("bunyan", 80, "app_logging", "Node.js Bunyan logger output", (), ("javascript", "logging")),
    ("serilog", 80, "app_logging", ".NET Serilog structured logging output", (), ("dotnet", "logging")),
    ("nlog", 80, "app_logging", ".NET NLog logger output", (), ("dotnet", "logging")),
    ("ruby_logger", 80, "app_logging", "Ruby standard Logger output", (), ("ruby", "logging")),
    ("rails_log", 80, "app_logging", "Ruby on Rails application log output", ("rails",), ("ruby", "logging", "web")),
    ("iptables", 80, "infrastructure", "Linux iptables firewall log", (), ("infrastructure", "security")),
    ("pf", 80, "infrastructure", "BSD PF (Packet Filter) firewall log", ("pf_firewall",), ("infrastructure", "security")),
    ("cisco_asa", 80, "infrastructure", "Cisco ASA firewall log", ("asa",), ("infrastructure", "security")),
    ("vpc_flow", 80, "infrastructure", "AWS/GCP VPC flow log", ("vpc_flow_log",), ("infrastructure", "cloud")),
    ("kubernetes", 80, "infrastructure", "Kubernetes container/pod log", ("k8s",), ("infrastructure", "cloud")),
    ("windows_event", 80, "infrastructure", "Windows Event Log", ("windows", "eventlog"), ("infrastructure", "security")),
    ("auditd", 80, "infrastructure", "Linux auditd audit log", ("audit",), ("infrastructure", "security")),
    ("s3_access", 80, "infrastructure", "AWS S3 bucket access log", ("s3_access_log",), ("infrastructure", "cloud")),
    ("ansible_text", 80, "infrastructure_tool", "Ansible playbook output", ("ansible",), ("infrastructure", "ci", "python")),
    ("lcov", 80, "coverage", "LCOV/gcov code coverage format", ("gcov", "lcov_info"), ("c_cpp", "coverage")),
    ("hdfs", 80, "distributed_system", "Hadoop HDFS log output", ("hadoop_hdfs",), ("distributed", "java")),
    ("spark", 80, "distributed_system", "Apache Spark log output", ("apache_spark",), ("distributed", "java")),
    ("android", 80, "distributed_system", "Android logcat output", ("logcat", "android_logcat"), ("distributed", "mobile")),
    ("zookeeper", 80, "distributed_system", "Apache Zookeeper log output", ("zk", "apache_zookeeper"), ("distributed", "java")),
    ("openstack", 80, "distributed_system", "OpenStack service log output", ("nova", "neutron", "cinder"), ("distributed", "cloud", "python")),
    ("bgl", 80, "distributed_system", "Blue Gene/L supercomputer log output", ("bluegene", "blue_gene_l"), ("distributed",)),
)

#: format -> (kind, pattern): commands whose output is in the format
COMMANDS = {
    "eslint_json": (("like", r"eslint%-f json%"), ("like", r"eslint%--format json%"), ("like", r"npx eslint%-f json%"), ("like", r"npx eslint%--format json%"), ("regexp", r"eslint.*(-f|--format)[= ]?json"),),
    "rubocop_json": (("like", r"rubocop%-f json%"), ("like", r"rubocop%--format json%"), ("like", r"bundle exec rubocop%-f json%"), ("regexp", r"rubocop.*(-f|--format)[= ]?json"),),
    "shellcheck_json": (("like", r"shellcheck%-f json%"), ("like", r"shellcheck%--format=json%"), ("like", r"shellcheck%--format json%"), ("regexp", r"shellcheck.*(-f|--format)[= ]?json"),),
    "clippy_json": (("like", r"cargo clippy%--message-format=json%"), ("like", r"cargo clippy%--message-format json%"), ("regexp", r"cargo\s+clippy.*--message-format[= ]?json"),),
    "hadolint_json": (("like", r"hadolint%-f json%"), ("like", r"hadolint%--format json%"), ("regexp", r"hadolint.*(-f|--format)[= ]?json"),),
    "bandit_json": (("like", r"bandit%-f json%"), ("like", r"bandit%--format json%"), ("regexp", r"bandit.*(-f|--format)[= ]?json"),),
    "trivy_json": (("like", r"trivy%-f json%"), ("like", r"trivy%--format json%"), ("like", r"trivy%--format=json%"), ("regexp", r"trivy.*(-f|--format)[= ]?json"),),
    "gotest_json": (("like", r"go test -json%"), ("regexp", r"go\s+test.*-json"),),
    "cargo_test_json": (("like", r"cargo test%--format=json%"), ("like", r"cargo test%-- --format json%"), ("regexp", r"cargo\s+test.*--format[= ]json"),),
    "pytest_text": (("literal", r"pytest"), ("like", r"pytest %"), ("like", r"python -m pytest%"), ("like", r"python3 -m pytest%"), ("regexp", r"py\.?test"),),
    "gtest_text": (("regexp", r".*_test$"), ("regexp", r".*_tests$"), ("like", r"%--gtest_%"),),
    "rspec_text": (("literal", r"rspec"), ("like", r"rspec %"), ("like", r"bundle exec rspec%"), ("regexp", r"(bundle exec )?rspec"),),
    "mocha_chai_text": (("literal", r"mocha"), ("like", r"mocha %"), ("like", r"npx mocha%"), ("like", r"npm test%"), ("like", r"yarn test%"),),
    "nunit_xunit_text": (("like", r"dotnet test%"), ("like", r"nunit-console%"), ("like", r"vstest.console%"), ("regexp", r"dotnet\s+test"),),
    "playwright_text": (("like", r"playwright test%"), ("like", r"npx playwright test%"), ("like", r"yarn playwright test%"), ("like", r"pnpm playwright test%"), ("regexp", r"playwright\s+test.*"),),
    "playwright_json": (("like", r"playwright test%--reporter=json%"), ("like", r"playwright test%--reporter json%"), ("like", r"npx playwright test%--reporter=json%"), ("like", r"npx playwright test%--reporter json%"),),
    "gotest_text": (("like", r"go test%"), ("regexp", r"go\s+test\s+(?!.*-json)"),),
    "gcc_text": (("literal", r"gcc"), ("like", r"gcc %"), ("like", r"gcc-%"), ("literal", r"g++"), ("like", r"g++ %"), ("like", r"g++-%"), ("literal", r"clang"), ("like", r"clang %"), ("like", r"clang-%"), ("literal", r"clang++"), ("like", r"clang++ %"), ("like", r"clang++-%"), ("literal", r"cc"), ("like", r"cc %"), ("literal", r"c++"), ("like", r"c++ %"), ("literal", r"gfortran"), ("like", r"gfortran %"), ("literal", r"gnat"), ("like", r"gnat %"), ("like", r"gnatmake %"),),
    "make_error": (("literal", r"make"), ("like", r"make %"), ("literal", r"gmake"), ("like", r"gmake %"),),
    "cmake_build": (("literal", r"cmake"), ("like", r"cmake %"), ("like", r"cmake --build%"),),
    "bazel_build": (("like", r"bazel build%"), ("like", r"bazel test%"), ("like", r"bazel run%"), ("regexp", r"bazel\s+(build|test|run)"),),
    "maven_build": (("literal", r"mvn"), ("like", r"mvn %"), ("like", r"./mvnw%"), ("regexp", r"(\./)?mvnw?\s+"),),
    "gradle_build": (("literal", r"gradle"), ("like", r"gradle %"), ("like", r"./gradlew%"), ("regexp", r"(\./)?gradlew?\s+"),),
    "unity_editor": (("like", r"unity-editor%"), ("like", r"Unity%"),),
    "cargo_build": (("like", r"cargo build%"), ("like", r"cargo check%"), ("like", r"cargo run%"), ("like", r"cargo test%"), ("like", r"cargo clippy%"), ("like", r"cargo fmt%"), ("regexp", r"cargo\s+(build|check|run|test|clippy|fmt)"),),
    "node_build": (("like", r"npm run%"), ("like", r"npm install%"), ("like", r"npm ci%"), ("like", r"yarn %"), ("like", r"pnpm %"), ("regexp", r"(npm|yarn|pnpm)\s+"),),
    "docker_build": (("literal", r"docker build"), ("like", r"docker build%"), ("like", r"docker-compose%"), ("literal", r"buildx build"),),
    "pylint_text": (("literal", r"pylint"), ("like", r"pylint %"), ("like", r"python -m pylint%"), ("like", r"python3 -m pylint%"),),
    "mypy_text": (("literal", r"mypy"), ("like", r"mypy %"), ("like", r"python -m mypy%"), ("like", r"python3 -m mypy%"),),
    "flake8_text": (("literal", r"flake8"), ("like", r"flake8 %"), ("like", r"python -m flake8%"), ("like", r"python3 -m flake8%"),),
    "black_text": (("like", r"black --check%"), ("like", r"black --diff%"), ("like", r"python -m black%"), ("regexp", r"black\s+(--check|--diff)"),),
    "yapf_text": (("literal", r"yapf"), ("like", r"yapf %"), ("like", r"yapf --diff%"), ("like", r"python -m yapf%"),),
    "clang_tidy_text": (("literal", r"clang-tidy"), ("like", r"clang-tidy %"), ("like", r"run-clang-tidy%"),),
    "autopep8_text": (("literal", r"autopep8"), ("like", r"autopep8 %"), ("like", r"autopep8 --diff%"), ("like", r"python -m autopep8%"),),
    "isort_text": (("literal", r"isort"), ("like", r"isort %"), ("like", r"isort --check%"), ("like", r"isort --diff%"), ("like", r"python -m isort%"),),
    "bandit_text": (("literal", r"bandit"), ("like", r"bandit %"), ("like", r"python -m bandit%"),),
    "ruff_text": (("literal", r"ruff"), ("like", r"ruff %"), ("like", r"ruff check%"), ("like", r"python -m ruff%"),),
    "ruff_json": (("like", r"ruff check%--output-format=json%"), ("like", r"ruff check%--output-format json%"), ("like", r"ruff%--format=json%"), ("like", r"ruff%--format json%"),),
    "eslint_text": (("literal", r"eslint"), ("like", r"eslint %"), ("like", r"npx eslint %"), ("like", r"yarn eslint %"), ("like", r"pnpm eslint %"), ("regexp", r"eslint\s+(?!.*(-f|--format)\s*json)"),),
    "rubocop_text": (("literal", r"rubocop"), ("like", r"rubocop %"), ("like", r"bundle exec rubocop %"), ("regexp", r"rubocop\s+(?!.*(-f|--format)\s*json)"),),
    "shellcheck_text": (("literal", r"shellcheck"), ("like", r"shellcheck %"), ("regexp", r"shellcheck\s+(?!.*(-f|--format)[= ]?json)"),),
    "hadolint_text": (("literal", r"hadolint"), ("like", r"hadolint %"), ("like", r"hadolint Dockerfile%"), ("regexp", r"hadolint\s+(?!.*(-f|--format)[= ]?json)"),),
    "terraform_text": (("like", r"terraform plan%"), ("like", r"terraform apply%"), ("like", r"terraform validate%"), ("regexp", r"terraform\s+(plan|apply|validate|destroy)"),),
    "github_cli": (("like", r"gh run view%"), ("like", r"gh run list%"), ("like", r"gh workflow%"), ("regexp", r"gh\s+(run|workflow)"),),
    "ansible_text": (("literal", r"ansible-playbook"), ("like", r"ansible-playbook %"), ("literal", r"ansible"), ("like", r"ansible %"),),
    "lcov": (("literal", r"lcov"), ("like", r"lcov %"), ("literal", r"geninfo"), ("like", r"geninfo %"),),
}
