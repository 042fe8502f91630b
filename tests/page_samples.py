"""Hand-made pages for the extraction tests."""

# Tags, class names, attribute names and labels are the index's own markup, which the rules must match.

SIDEBAR = """
<div class="sidebar-section verified">
  <h6>Owner</h6>
  <ul class="vertical-tabs__list"><li><a href="/org/green-lab/">Green &amp; Lab</a></li></ul>
  <h6>Maintainers</h6>
  <span class="sidebar-section__user-gravatar-text"> mira </span>
  <span class="sidebar-section__user-gravatar-text">Otto</span>
  <h6>Project links</h6>
  <ul class="vertical-tabs__list"><li><a class="x" href="https://green.example/?a=1&amp;b=2">Home</a></li></ul>
  <h6>Meta</h6>
  <ul><li>
     <span>
       <strong>Author:</strong> <a href="mailto:mira@green.example">Mira M.</a>
     </span></li></ul>
</div>
<div class="sidebar-section unverified">
  <h6>Project links</h6>
  <ul class="vertical-tabs__list">
    <li><a href="https://docs.green.example">Docs</a></li>
    <li><a href="https://green.example/tracker">home</a></li>
  </ul>
  <h6>Meta</h6>
  <ul>
  <li><span>
      <strong>License Expression:</strong> Apache-2.0
      <br><small><i><a href="https://spdx.example/">SPDX</a></i></small></span></li>
  <li><strong>License:</strong> ignored text</li>
  <li><span><strong>Author:</strong> Other Person</span></li>
  <li><span><strong>Maintainer:</strong> <a href="mailto:otto@green.example">Otto O.</a></span></li>
  <li class="tags"><span><i class="fa"></i> </span><span class="package-keyword">
      graphs
,   </span><span class="package-keyword"> , </span><span class="package-keyword">trees</span></li>
  <li><span><strong>Requires:</strong> Python &lt;4,&gt;=3.10</span></li>
  <li><strong>Provides-Extra:</strong> <code>all</code>, <code> speed </code></li>
  </ul>
  <h6>Classifiers</h6>
  <ul class="sidebar-section__classifiers">
    <li><strong>License</strong><ul><li><a href="/s">OSI Approved</a></li></ul></li>
    <li><strong>Topic</strong><ul><li><a href="/s">Text :: A &amp; B</a></li><li><a href="/s">Utilities</a></li></ul></li>
  </ul>
</div>
"""

FILES = """
<div id="files">
  <h2>Download files</h2><p>See <a href="https://files.pythonhosted.org/help">help</a></p>
  <h3>Source Distribution</h3>
  <div class="file"><div class="card"><a href="https://files.pythonhosted.org/p/green-2.0.tar.gz">green-2.0.tar.gz</a>
    (<a href="#green-2.0.tar.gz">details</a>)</div></div>
  <h3>%(wheel_heading)s</h3>
  <div class="file"><div class="card"><a href="https://files.pythonhosted.org/p/green-2.0-py3-none-any.whl">
     green-2.0-py3-none-any.whl</a></div></div>
  <h3>Something else</h3>
  <div class="file"><a href="https://files.pythonhosted.org/p/green-2.0-cp312.whl">green-2.0-cp312.whl</a></div>
</div>
<div id="green-2.0.tar.gz" class="tab">
  <p>Details</p><h3>File metadata</h3>
  <ul><li>Download URL: <a href="/p/green-2.0.tar.gz">green-2.0.tar.gz</a></li>
  <li>Upload date: <time datetime="2025-05-01T10:20:30+0000">May 1</time></li>
  <li>Size: 3.5 kB</li><li>Tags: Source</li>
  <li>Uploaded using Trusted Publishing? Yes</li><li>Uploaded via: tool/1.0 &amp; more</li></ul>
  <table class="table table--hashes"><thead><tr><th scope="col">Algorithm</th></tr></thead><tbody>
    <tr><th scope="row">SHA256</th><td><code>aa01</code></td></tr>
    <tr><th scope="row">MD5</th><td><code>bb01</code> <button>copy</button></td></tr>
    <tr><th scope="row">BLAKE2b-256</th><td><code>cc01</code></td></tr></tbody></table>
  <div><h3>Provenance</h3>
   <ul><li>Statement type: <code>https://statement.example/v1</code></li>
   <li>Predicate type: <code>https://predicate.example/v1</code></li>
   <li>Subject name: <code>green-2.0.tar.gz</code></li><li>Subject digest: <code>aa01</code></li>
   <li>Sigstore transparency entry: <a href="https://log.example/?logIndex=41">41</a></li>
   <li>Sigstore transparency entry: <a href="https://log.example/?logIndex=77&amp;x=1">77</a></li>
   <li>Sigstore integration time: <time datetime="2025-05-01T10:21:00+0000">May 1</time></li></ul>
   <div><ul><li>Permalink: <a><code>https://code.example/green@abc@def</code></a></li>
   <li>Branch / Tag: <code>refs/tags/2.0</code></li></ul></div>
   <div><ul><li>Token Issuer: <code>https://token.example</code></li>
   <li>Runner Environment: <code>hosted</code></li><li>Publication workflow: <code>pub.yml@abc</code></li>
   <li>Trigger Event: <code>push</code></li></ul></div></div>
</div>
<div id="green-2.0-py3-none-any.whl">
  <a href="/p/green-2.0-py3-none-any.whl">x</a>
  <ul><li>Upload date: <time datetime="2025-05-01T10:22:30+0000">May 1</time></li>
  <li>Size: 1.5 MB</li><li>Tags: Python 3</li><li>Uploaded using Trusted Publishing? No</li></ul>
  <table class="table table--hashes"><tbody>
    <tr><th scope="row">SHA256</th><td><code>aa02</code></td></tr></tbody></table>
</div>
<div id="green-2.0-cp312.whl"><ul><li>Size: what</li><li>Tags: </li></ul></div>
<div id="unlisted.whl"><ul><li>Size: 1 MB</li></ul></div>
"""

TIMELINE = """
<div id="history"><div class="release-timeline">
  <div class="release release--latest"><div class="release__meta"><span class="badge">x</span></div>
    <a class="card release__card" href="/project/green/3.0b1/"><p class="release__version">
      3.0b1 <span class="badge badge--warning">pre-release</span></p></a></div>
  <div class="release"><p class="release__version">2.0</p></div>
  <div class="release"><p class="release__version">1.5 <span class="badge badge--danger">yanked</span></p>
    <p class="release__yanked-reason"><strong>Broken &lt;wheel&gt;</strong></p></div>
  <div class="release"><p class="release__version">1.5</p><p class="release__yanked-reason">stale</p></div>
</div></div>
"""


def page(version_name="green 2.0", wheel_heading="Built Distribution", status="This project has been quarantined",
         timeline=TIMELINE, sidebar=SIDEBAR):
    return f"""<!DOCTYPE html><html><head><title>green</title>
<script>var x = '<div class="sidebar-section verified"><h6>Owner</h6>';</script></head><body>
<!-- <div class="release-timeline"> -->
<div class="package-header__left"><h1 class="package-header__name">
  {version_name}
</h1></div>
<div class="package-header__right"><a class="status-badge" href="#"><span>{status}</span></a>
<p class="package-header__date">Released: <time datetime="2025-05-01T10:20:00+0000">May 1</time></p></div>
<p class="package-description__summary"> Graphs &amp; trees </p>
<div class="vertical-tabs__tabs">{sidebar}</div>
<div class="vertical-tabs__content" style="display:none">{sidebar}</div>
<div id="description"><div class="project-description">
  <p>Hi</p><div class="box"><div>nested</div> tail</div> &lt;end&gt; </div></div>
{timeline}
{FILES % dict(wheel_heading=wheel_heading)}
</body></html>"""


def profile(joined=True):
    block = ('<div class="author-profile__metadiv"><i class="fa fa-calendar-alt" aria-hidden="true"></i>'
             '<span class="sr-only">Date joined</span> Joined <time datetime="2019-03-04T05:06:07+0000">2019</time></div>')
    return ('<html><body><div class="author-profile__metadiv"><i class="fa fa-user-circle"></i>'
            '<time datetime="1999-01-01T00:00:00+0000">no</time></div>' + (block if joined else "") + "</body></html>")
